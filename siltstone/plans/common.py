"""What the three pipelines share."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.dates import CHANGE_FLOOR, timestamp
from siltstone.operators.journal import high_water_marks, load_records
from siltstone.schemas import columns
from siltstone.session import release
from siltstone.sources.remote import Source, align_columns

State = dict[str, DataFrame]
Save = Callable[[DataFrame, str], DataFrame]

__all__ = ["JOURNAL", "Save", "State", "declared", "each", "extend", "in_reach", "in_steps", "lazily", "load_records", "marks", "refuse_reuse", "small"]

JOURNAL = "staging.last_update_data"


def lazily(df: DataFrame, name: str) -> DataFrame:
    """A `save` that writes nothing: the step stays part of the next plan."""
    return df


SIDE_BY_SIDE = 3  # loads at a time: a large and some small ones fill a cluster, and the driver holds the plans and broadcasts of each


def each(names: Iterable[str], load: Callable[[str], tuple[str, DataFrame]]) -> State:
    """Tables that do not depend on each other, loaded side by side, so that the small
    ones do not each hold up the cluster."""
    with ThreadPoolExecutor(max_workers=SIDE_BY_SIDE) as pool:
        return dict(pool.map(load, names))


def in_steps(state: State, *steps: Callable[[State], State]) -> State:
    """The state after one step after the other. Between them the driver drops what a step leaves behind."""
    for step in steps:
        state = state | step(state)
        release(next(iter(state.values())).sparkSession)
    return state


def in_reach(save: Save, target: DataFrame, table: str, delta: DataFrame) -> DataFrame:
    """The part of a target that a delta can change: what the store says, else all of it."""
    narrow = getattr(save, "narrow", None)
    return narrow(target, table, delta) if narrow else target


def extend(save: Save, target: DataFrame, added: DataFrame, table: str) -> DataFrame:
    """An append-only table with more rows; a store writes just these."""
    append = getattr(save, "append", None)
    return append(added, table) if append else save(target.unionByName(added), table)


SMALL = 500_000  # rows of two keys that a join may broadcast


def small(registry: DataFrame) -> DataFrame:
    """A key registry marked to be broadcast, if it is small: what is joined with it, in most cases a whole fact, is not dealt out.

    A larger one is merged, however small its files are: keys that follow each other take some fifty times as much memory in the driver.
    """
    return F.broadcast(registry) if registry.count() <= SMALL else registry.hint("merge")


def declared(source: Source, tables: dict[str, str], layer_table: str) -> tuple[DataFrame, list[str]]:
    """The source table with the declared columns it lacks added as NULL, and their names."""
    wanted = columns(tables, layer_table)
    return align_columns(source(layer_table.split(".")[1]), wanted), list(wanted)


def marks(journal: DataFrame, tables: list[str]) -> dict[str, str]:
    """High-water marks of a handful of tables, as values."""
    rows = high_water_marks(journal, tables, CHANGE_FLOOR).select("table_name", F.col("update_dt").cast("string")).collect()
    return {r[0]: r[1] for r in rows}


def refuse_reuse(journal: DataFrame, load_ts: str) -> None:
    """A load time must be newer than all before; a reused one would repeat version keys."""
    if not journal.filter(F.col("update_dt") >= timestamp(load_ts)).isEmpty():
        raise ValueError(f"load time {load_ts} is not after the last load")
