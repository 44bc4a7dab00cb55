"""A change feed driven by Structured Streaming.

The loads are batch loads. This runs one per micro-batch of arriving files and stops
when the feed is drained, so a schedule can start it as often as changes should show.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def apply_feed(feed: DataFrame, load: Callable[[DataFrame, int], None], checkpoint: str,
               done: Callable[[int], bool] | None = None) -> None:
    """Hand each micro-batch of a streaming frame to `load(delta, batch_id)`.

    After a lost driver the last batch is given again. Where its load failed before its commit, it runs
    again; where it was committed, `done(batch_id)` says so and the batch is passed over. With a store and a
    load time derived from the batch id, `done` is `lambda i: store.is_loaded(time_of(i))`.
    """
    def once(delta: DataFrame, batch_id: int) -> None:
        if done is None or not done(batch_id):
            load(delta, batch_id)

    query = feed.writeStream.foreachBatch(once).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
