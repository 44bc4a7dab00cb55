"""What several operators of this package share: reading tables, text as bytes, Arrow batches."""

from __future__ import annotations

import gc
import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.session import materialize, tune

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BATCH_BYTES = 8 << 20

__all__ = ["BATCH_BYTES", "ascii_lower", "by_bytes", "discard", "materialize", "per_worker", "prepared", "raw", "release", "table"]


def prepared(spark: SparkSession) -> SparkSession:
    """Adaptive settings, and small Arrow batches so that very long texts don't pile up in a worker."""
    tune(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; all other characters stay."""
    return F.translate(text, UPPER, LOWER)


def release(spark: SparkSession) -> None:
    """Let Spark remove shuffle files of steps that are written: it does so when the driver has collected their owners."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(*stored: DataFrame) -> None:
    """Delete tables of `materialize` that no later step reads, and release the shuffle files behind them."""
    for df in stored:
        context = df.sparkSession.sparkContext
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            where = context._jvm.org.apache.hadoop.fs.Path(folder)
            where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)
    release(stored[0].sparkSession)


def raw(text: str | bytes | None) -> bytes:
    """The UTF-8 bytes of a text; none of a null."""
    return b"" if text is None else text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass")


def by_bytes(batches: Iterator[pa.RecordBatch], column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that none holds more than `limit` bytes of `column` (a longer text comes alone)."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for row, size in enumerate(sizes):
            if total and total + size > limit:
                yield batch.slice(start, row - start)
                start, total = row, 0
            total += size
        if start < batch.num_rows:
            yield batch.slice(start)


def per_worker(name: str, key: Any, build: Callable[[], Any]) -> Any:
    """What `build` gives, kept in the Python worker for its later tasks; one value per name, made anew when the key is another one."""
    kept = sys.modules.setdefault("siltstone_kept", types.ModuleType("siltstone_kept")).__dict__
    if name not in kept or kept[name][0] != key:
        kept[name] = key, build()
    return kept[name][1]
