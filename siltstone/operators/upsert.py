"""Upserts on immutable tables: state in, state out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.dates import CHANGE_FLOOR, timestamp
from siltstone.operators.filters import bits_for, known_filter
from siltstone.session import materialize, observed


def upsert(target: DataFrame, delta: DataFrame, key: str, gone: DataFrame | None = None, few: bool | None = None) -> DataFrame:
    """UPS-1: target rows whose key is in the delta are replaced by the whole delta.

    `gone` gives the keys to remove where they differ from those of the delta. `few` says what to expect of these, so that
    only a part of a large target is shuffled: a few of the target's keys (True), or nearly all of them (False). The result is the same.
    """
    keys = (delta if gone is None else gone).select(key)
    if few is None or target.isEmpty():
        return target.join(keys, key, "left_anti").unionByName(delta.select(*target.columns))
    if few:
        known, keys = _known(keys, key)
        kept = target.filter(~known).unionByName(target.filter(known).join(keys, key, "left_anti").select(*target.columns))
    else:  # the keys alone are dealt out, and then the rows of those that stay
        known, staying = _known(target.select(key).filter(F.col(key).isNotNull()).join(keys, key, "left_anti"), key)
        kept = target.filter(F.col(key).isNull()).unionByName(target.filter(known).join(staying, key, "left_semi").select(*target.columns))
    return kept.unionByName(delta.select(*target.columns))


MANY = 500_000  # keys that are never broadcast, however small their files are


def _known(keys: DataFrame, key: str) -> tuple[Column, DataFrame]:
    """A filter that knows the keys (`known_filter`, but never NULL), and the keys, written once."""
    keys = materialize(keys, "keys")
    n = keys.count()
    return F.coalesce(known_filter(keys, key, bits_for(n)), F.lit(False)), keys.hint("merge") if n > MANY else keys


def newest(target: DataFrame, column: str) -> Column:
    """Newest stamp of a table as a scalar subquery; very old when the table is empty.

    Spark runs it first and hands the value to the scan of the other table.
    """
    return target.agg(F.coalesce(F.max(column), timestamp(CHANGE_FLOOR))).scalar()


def stored_with_mark(df: DataFrame, name: str, stamp: str = "last_update") -> tuple[DataFrame, Column]:
    """`df` written once, and its newest stamp, observed while it was written: the mark of the next delta."""
    stored, found = observed(df, name, newest=F.max(stamp).cast("string"))
    return stored, timestamp(found["newest"] or CHANGE_FLOOR)


def changes_since_target(target: DataFrame, source: DataFrame, stamp: str = "last_update", *, inclusive: bool = False,
                         deleted: str | None = None, mark: Column | None = None) -> DataFrame:
    """Source rows newer than the newest row of the target.

    Strict and on one stamp by default, so a soft delete without a touch and a late
    row with an equal stamp are passed over. `inclusive` and `deleted` widen that. With the `mark` that
    `stored_with_mark` observed the target isn't read.
    """
    mark = newest(target, stamp) if mark is None else mark
    test = F.col(stamp) >= mark if inclusive else F.col(stamp) > mark
    if deleted:
        test = test | (F.col(deleted) >= mark if inclusive else F.col(deleted) > mark)
    return source.filter(test)


def upsert_since(target: DataFrame, source: DataFrame, key: str, stamp: str = "last_update", **options) -> DataFrame:
    """UPS-2: upsert of the source rows newer than the target (options of `changes_since_target`)."""
    return upsert(target, changes_since_target(target, source, stamp, **options), key)
