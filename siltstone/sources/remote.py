"""Where source tables come from: a remote database or a folder of Parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Source = Callable[[str], DataFrame]


def parquet_source(spark: SparkSession, folder: str) -> Source:
    """`source(name)` reads `<folder>/<name>.parquet`."""
    return lambda name: spark.read.parquet(f"{folder}/{name}.parquet")


# A column to split a table by, or that and its (lowest, highest) value.
Split = str | tuple[str, int, int]


def jdbc_source(spark: SparkSession, url: str, schema: str = "public", split: dict[str, Split] | None = None,
                tasks: int | None = None, fetch_rows: int = 10_000, **options: str) -> Source:
    """`source(name)` scans a remote table; its columns are taken from the database.

    `split` maps a table to a numeric column; its bounds are asked from the database, unless they are given.
    Then `tasks` tasks read the table side by side, by default one for each core. Rows outside the bounds are read,
    too, by the first and last task. Rows come in pieces of `fetch_rows`, so that no task holds its whole share.
    Filters and column lists on the result are sent to the database.
    """
    common = {"url": url, "preferTimestampNTZ": "true", "fetchsize": str(fetch_rows), **options}

    def read(name: str) -> DataFrame:
        reader = spark.read.format("jdbc").options(dbtable=f"{schema}.{name}", **common)
        if split and name in split:
            column, *bounds = (split[name],) if isinstance(split[name], str) else split[name]
            if not bounds:
                asked = f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {schema}.{name}"
                bounds = spark.read.format("jdbc").options(query=asked, **common).load().first()
            if bounds[0] is not None:
                reader = reader.options(partitionColumn=column, lowerBound=str(bounds[0]), upperBound=str(bounds[1]),
                                        numPartitions=str(tasks or spark.sparkContext.defaultParallelism))
        return reader.load()

    return read


def align_columns(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Add the columns of `wanted` (name → type) that the source lacks, as NULL.

    Columns the source already has stay as they are; extra ones pass through.
    """
    missing = {n: F.lit(None).cast(t) for n, t in wanted.items() if n not in df.columns}
    return df.withColumns(missing) if missing else df
