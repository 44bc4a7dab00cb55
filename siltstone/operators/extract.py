"""Extraction of whole tables and of changes since a mark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.dates import timestamp


def extract_full(source: DataFrame, columns: Sequence[str]) -> DataFrame:
    """EXT-3: the listed columns of every source row."""
    return source.select(*columns)


def changed_since(mark: str, *stamps: str | Column) -> Column:
    """True where any stamp is at or after the mark (NULL stamps do not count)."""
    since = timestamp(mark)
    test = F.lit(False)
    for stamp in stamps:
        stamp = F.col(stamp) if isinstance(stamp, str) else stamp
        test = test | (stamp >= since)
    return test


def extract_incremental(source: DataFrame, columns: Sequence[str], mark: str, updated: str = "last_update",
                        deleted: str = "deleted") -> DataFrame:
    """EXT-4: rows updated or soft-deleted at or after the mark (inclusive)."""
    return source.filter(changed_since(mark, updated, deleted)).select(*columns)


def extract_incremental_enriched(fact: DataFrame, parent: DataFrame, key: str, parent_columns: Sequence[str],
                                 columns: Sequence[str], mark: str, updated: str = "last_update",
                                 deleted: str = "deleted") -> DataFrame:
    """EXT-5: changed fact rows with columns of their parent; a row also counts as
    changed when its parent was updated. Rows without a parent drop.

    "Fact changed OR parent changed" cannot be pushed into either scan. The two
    disjoint halves can: changed facts with any parent, and unchanged facts with a
    changed parent. Each join then has one side of the size of the change.
    """
    own = changed_since(mark, updated, deleted)
    keep = list(dict.fromkeys([key, *parent_columns]))
    with_any = fact.filter(own).join(parent.select(*keep), key)
    with_changed = fact.filter(~F.coalesce(own, F.lit(False))).join(
        parent.filter(changed_since(mark, updated)).select(*keep), key)
    return with_any.select(*columns).unionByName(with_changed.select(*columns))
