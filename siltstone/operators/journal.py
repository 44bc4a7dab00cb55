"""The load journal: which table was loaded when."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.dates import CHANGE_FLOOR, timestamp

JOURNAL_SCHEMA = "table_name string, update_dt timestamp_ntz"


def record_load(journal: DataFrame, table: str, load_ts: str | datetime) -> DataFrame:
    """EXT-2: the journal with one more row. The load time is given, never the clock."""
    return record_loads(journal, [table], load_ts)


def table_rows(spark: SparkSession, tables: list[str]) -> DataFrame:
    """One row per table name, as literals."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(t) for t in tables])).alias("table_name"))


def load_records(spark: SparkSession, tables: list[str], load_ts: str | datetime) -> DataFrame:
    """Journal rows of one load."""
    return table_rows(spark, tables).withColumn("update_dt", timestamp(load_ts))


def record_loads(journal: DataFrame, tables: list[str], load_ts: str | datetime) -> DataFrame:
    return journal.unionByName(load_records(journal.sparkSession, tables, load_ts))


def high_water_marks(journal: DataFrame, tables: list[str], default: str = CHANGE_FLOOR) -> DataFrame:
    """EXT-1: newest load of each table, the default for one never loaded."""
    newest = journal.filter(F.col("table_name").isin(tables)).groupBy("table_name").agg(F.max("update_dt").alias("newest"))
    return table_rows(journal.sparkSession, tables).join(newest, "table_name", "left").select(
        "table_name", F.coalesce("newest", timestamp(default)).alias("update_dt"))


def high_water_mark(journal: DataFrame, table: str, default: str = CHANGE_FLOOR) -> str:
    """The same for one table as a value, so that scans can be filtered by a literal."""
    newest = journal.filter(F.col("table_name") == table).agg(
        F.coalesce(F.max("update_dt"), timestamp(default)).cast("string"))
    return newest.first()[0]


def previous_load_times(journal: DataFrame) -> DataFrame:
    """EXT-6: second newest load of each table, NULL where there was only one.

    Two small aggregates instead of a window over each table's whole history, so
    a table with very many loads is still combined map-side.
    """
    newest = journal.groupBy("table_name").agg(F.max("update_dt").alias("newest"))
    older = F.col("update_dt") < F.col("newest")
    return journal.join(newest, "table_name").groupBy("table_name").agg(
        F.max(F.when(older, F.col("update_dt"))).alias("below"),
        F.count(F.when(~older, 1)).alias("ties"), F.max("newest").alias("newest"),
    ).select("table_name", F.when(F.col("ties") > 1, F.col("newest")).otherwise(F.col("below")).alias("update_dt"))


def previous_load_time(journal: DataFrame, table: str) -> str | None:
    row = previous_load_times(journal.filter(F.col("table_name") == table)).select(
        F.col("update_dt").cast("string")).first()
    return row[0] if row else None
