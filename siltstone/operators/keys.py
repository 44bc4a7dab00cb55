"""Surrogate keys: registries of (surrogate, natural) pairs and their use."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.session import materialize

@dataclass(frozen=True)
class Registry:
    """A key registry and the names of its two columns."""

    df: DataFrame
    sk: str
    nk: str


BLOCK = 1024  # partitions whose counts are summed together


def _offsets(placed: DataFrame) -> DataFrame:
    """(_part, _shift): what turns a generated id into the number of its row, from one count per partition.

    Two levels of prefix sums: of the counts inside each block of partitions, and of the blocks' sums.
    """
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first")).withColumn(
        "_block", F.floor(F.col("_part") / BLOCK))
    earlier = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_block").orderBy("_part").rowsBetween(*earlier)
    sums = counts.groupBy("_block").agg(F.sum("_rows").alias("_rows"))  # one row per BLOCK partitions
    over_blocks = Window.partitionBy(F.lit(0)).orderBy("_block").rowsBetween(*earlier)
    starts = sums.select("_block", F.coalesce(F.sum("_rows").over(over_blocks), F.lit(0)).alias("_before"))
    return counts.withColumn("_inside", F.coalesce(F.sum("_rows").over(inside), F.lit(0))).join(starts, "_block").select(
        "_part", (F.col("_before") + F.col("_inside") - F.col("_first")).alias("_shift"))


def number_rows(rows: DataFrame, order: str | Sequence[Column | str], name: str, after: Column) -> DataFrame:
    """Dense numbers above `after` in the order of `order`, without a one-task window.

    The rows are range-sorted over all tasks and written once with their partition and a generated id, which counts the rows
    of a partition. A frame with one row per partition then says where each partition's numbers begin; nothing passes the driver.
    """
    order = [order] if isinstance(order, str) else list(order)
    placed = materialize(rows.sort(*order).withColumns({
        "_place": F.monotonically_increasing_id(), "_part": F.spark_partition_id()}), "numbering")
    numbered = placed.join(F.broadcast(_offsets(placed)), "_part")
    return numbered.withColumn(name, (after + F.col("_shift") + F.col("_place") + 1).cast("bigint")).drop("_place", "_part", "_shift")


def new_keys(registry: DataFrame, natural_keys: DataFrame, sk: str, nk: str) -> DataFrame:
    """Registry rows for the natural keys that have none, numbered in key order."""
    unseen = natural_keys.select(F.col(natural_keys.columns[0]).alias(nk)).filter(F.col(nk).isNotNull()).distinct().join(
        registry.select(nk), nk, "left_anti")
    top = registry.agg(F.coalesce(F.max(sk), F.lit(0).cast("bigint"))).scalar()
    return number_rows(unseen, nk, sk, top).select(*registry.columns)


def sync_keys(registry: DataFrame, natural_keys: DataFrame, sk: str, nk: str) -> DataFrame:
    """KEY-1: unseen natural keys are appended with the next surrogates in key order.

    Known surrogates never change.
    """
    return registry.unionByName(new_keys(registry, natural_keys, sk, nk))


def replace_keys(df: DataFrame, registries: Mapping[str, Registry]) -> DataFrame:
    """KEY-2: the natural keys in the listed columns give way to their surrogates.

    Inner joins: a row with an unknown key drops. Other columns stay as they are.
    """
    columns = df.columns
    for column, registry in registries.items():
        known = registry.df.select(F.col(registry.nk).alias(column), F.col(registry.sk).alias("_sk"))
        df = df.join(known, column).drop(column).withColumnRenamed("_sk", column)
    return df.select(*columns)


def fill_keys(rows: DataFrame, pk: str, known: DataFrame | None = None) -> DataFrame:
    """Give rows without a row key a new one above all known keys.

    Unique but with gaps, like a sequence; no shuffle. The caller must write the
    result before it uses the keys twice (`materialize` or a state table does).
    """
    top = F.lit(0).cast("bigint") if known is None else known.agg(F.coalesce(F.max(pk), F.lit(0).cast("bigint"))).scalar()
    return rows.withColumn(pk, F.coalesce(F.col(pk), top + 1 + F.monotonically_increasing_id()))
