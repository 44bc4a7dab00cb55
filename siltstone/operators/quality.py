"""Declared constraints as checks: each returns rows (check, subject, violations)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _count(test: Column) -> Column:
    return F.count(F.when(test, 1))


def _report(df: DataFrame, check: str, tests: Mapping[str, Column]) -> DataFrame:
    """All tests in one pass over the data, one row per subject."""
    totals = df.agg(F.array(*[F.struct(F.lit(check).alias("check"), F.lit(s).alias("subject"), _count(t).alias("violations"))
                              for s, t in tests.items()]).alias("r"))
    return totals.select(F.inline("r"))


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """DQ-1"""
    return _report(df, "not_null", {c: F.col(c).isNull() for c in columns})


def check_domain(df: DataFrame, column: str, values: Sequence[Any] | None = None, low: Any = None,
                 high: Any = None) -> DataFrame:
    """DQ-2: a list of values or a closed range. NULL passes, as in a CHECK."""
    bad = F.lit(False)
    if values is not None:
        bad = bad | ~F.col(column).isin(list(values))
    if low is not None:
        bad = bad | (F.col(column) < low)
    if high is not None:
        bad = bad | (F.col(column) > high)
    return _report(df, "domain", {column: bad})


def check_length(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """DQ-3"""
    return _report(df, "length", {c: F.length(c) > n for c, n in limits.items()})


def check_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """DQ-4: number of keys that occur more than once."""
    repeated = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return _report(repeated, "unique", {",".join(key): F.col("n") > 1})


def check_reference(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """DQ-5: child rows whose key the parent lacks; a NULL key passes.

    Child rows are counted per key first, so a key that most rows share is one row in
    the join.
    """
    counted = child.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("n"))
    missing = counted.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")
    return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(
        F.lit("reference").alias("check"), F.lit(fk).alias("subject"), "violations")


def missing_parents(child: DataFrame, key: str, parents: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """DQ-5 by row: (row_key, fk, parent_key) of each child row and foreign key that has no parent row, which an inner join with
    the parent drops. A NULL key passes.

    `parents` says for each foreign key the parent and its key. Rows are expanded to one per foreign key, so all
    parents are met in one anti-join.
    """
    wanted = child.select(F.col(key).alias("row_key"), F.inline(F.array(*[
        F.struct(F.lit(fk).alias("fk"), F.col(fk).cast("bigint").alias("parent_key")) for fk in parents])))
    known = reduce(DataFrame.unionByName, [p.select(F.lit(fk).alias("fk"), F.col(pk).cast("bigint").alias("parent_key")) for fk, (p, pk) in parents.items()])
    return wanted.filter(F.col("parent_key").isNotNull()).join(known.distinct(), ["fk", "parent_key"], "left_anti").select("row_key", "fk", "parent_key")


def check_schema(df: DataFrame, not_null: Sequence[str] = (), lengths: Mapping[str, int] | None = None) -> DataFrame:
    """NOT NULL and length declarations of a table, in one pass."""
    tests = {f"{c} not null": F.col(c).isNull() for c in not_null}
    tests |= {f"{c} at most {n}": F.length(c) > n for c, n in (lengths or {}).items()}
    return _report(df, "declared", tests)
