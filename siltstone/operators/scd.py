"""Slowly changing dimensions with validity intervals.

Every function takes the dimension as it was and returns it as it becomes. The key
lists of a step are taken from the state before the step, never after its inserts.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.dates import OPEN_END, OPEN_START, timestamp
from siltstone.functions.hashing import row_hash
from siltstone.operators.filters import known_filter


@dataclass(frozen=True)
class Span:
    """Names of the validity columns."""

    start: str = "effective_date_from"
    end: str = "effective_date_to"
    active: str = "is_active"


STAR_SPAN = Span()
CORP_SPAN = Span("date_effective_from", "date_effective_to")

Lookup = Callable[[DataFrame], DataFrame]


def is_live(span: Span = STAR_SPAN) -> Column:
    return F.col(span.active).eqNullSafe(F.lit(True))


def _marks(staged: DataFrame, key: str) -> DataFrame:
    """Per staged key: when it was deleted, or else when it was changed."""
    return staged.groupBy(key).agg(
        F.max("deleted").alias("_gone_at"),
        F.max(F.when(F.col("deleted").isNull(), F.col("last_update"))).alias("_changed_at"))


def _seen(dim: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """The staged keys that the dimension knows in any version.

    Reads the key column of the dimension only, and does not shuffle it when the
    change is small enough for Spark to broadcast.
    """
    return dim.select(key).join(staged.select(key), key, "left_semi").distinct().withColumn("_seen", F.lit(True))


def close_versions(dim: DataFrame, marks: DataFrame, key: str, at: Column, span: Span = STAR_SPAN) -> DataFrame:
    """Live versions of the marked keys end at `at` (where it is not NULL).

    Only the live versions are joined; history, which grows with every load, is passed
    on without a shuffle.
    """
    hit = at.isNotNull()
    live = dim.filter(is_live(span)).join(marks, key, "left").withColumns({
        span.end: F.when(hit, at).otherwise(F.col(span.end)), span.active: ~hit}).select(*dim.columns)
    return dim.filter(~is_live(span)).unionByName(live)


def _fit(rows: DataFrame, dim: DataFrame) -> DataFrame:
    """Bring new rows into the shape of the dimension; a missing row key is NULL until filled."""
    types = dict(dim.dtypes)
    return rows.select(*[(F.col(c) if c in rows.columns else F.lit(None)).cast(types[c]).alias(c) for c in dim.columns])


def scd2_soft_delete(dim: DataFrame, staged: DataFrame, key: str, span: Span = STAR_SPAN) -> DataFrame:
    """SCD-1: live versions of soft-deleted keys become inactive and end at the deletion."""
    gone = staged.filter(F.col("deleted").isNotNull())
    return close_versions(dim, _marks(gone, key), key, F.col("_gone_at"), span)


def new_versions(staged: DataFrame, span: Span = STAR_SPAN) -> DataFrame:
    """First versions: open at the start, ended where the row came in already deleted."""
    return staged.withColumns({
        span.start: timestamp(OPEN_START), span.end: F.coalesce("deleted", timestamp(OPEN_END)),
        span.active: F.col("deleted").isNull()})


def next_versions(staged: DataFrame, span: Span = STAR_SPAN) -> DataFrame:
    """Follow-up versions: from the change on."""
    return staged.withColumns({
        span.start: F.col("last_update"), span.end: timestamp(OPEN_END), span.active: F.lit(True)})


def scd2_insert_new(dim: DataFrame, staged: DataFrame, key: str, lookup: Lookup = lambda df: df,
                    span: Span = STAR_SPAN) -> DataFrame:
    """SCD-2: a first version for each key without any version. `lookup` adds the
    attributes; being an inner join, it drops rows whose parent is missing."""
    unseen = staged.join(_seen(dim, staged, key), key, "left_anti")
    return dim.unionByName(_fit(lookup(new_versions(unseen, span)), dim))


def scd2_version(dim: DataFrame, staged: DataFrame, key: str, lookup: Lookup = lambda df: df,
                 span: Span = STAR_SPAN, seen: DataFrame | None = None) -> DataFrame:
    """SCD-3: each known, not deleted staged row closes the live version and opens the next.

    Values are not compared. `seen` holds the keys known before SCD-2 ran.
    """
    seen = _seen(dim, staged, key) if seen is None else seen
    changed = staged.filter(F.col("deleted").isNull()).join(seen.select(key), key, "left_semi")
    closed = close_versions(dim, _marks(changed, key), key, F.col("_changed_at"), span)
    return closed.unionByName(_fit(lookup(next_versions(changed, span)), dim))


def scd2_merge(dim: DataFrame, staged: DataFrame, key: str, lookup: Lookup = lambda df: df, span: Span = STAR_SPAN,
               compare: Sequence[str] | None = None) -> DataFrame:
    """SCD-1 to SCD-3 in one pass over the dimension.

    One left join closes the live versions and one lookup chain serves both the first
    and the follow-up versions. `compare` lists attributes; a staged row that equals
    the live version in all of them is then left out.
    """
    if compare:
        live = dim.filter(is_live(span)).select(key, F.struct(*compare).alias("_now"))
        described = lookup(staged).select(*staged.columns, F.struct(*compare).alias("_new"))
        staged = described.join(live, key, "left").filter(
            F.col("deleted").isNotNull() | ~F.coalesce(F.col("_now").eqNullSafe(F.col("_new")), F.lit(False))
        ).select(*staged.columns)
    end = F.coalesce("_gone_at", "_changed_at")
    closed = close_versions(dim, _marks(staged, key), key, end, span)
    known = F.col("_seen").isNotNull()
    added = staged.join(_seen(dim, staged, key), key, "left").filter(~known | F.col("deleted").isNull()).withColumns({
        span.start: F.when(known, F.col("last_update")).otherwise(timestamp(OPEN_START)),
        span.end: F.coalesce("deleted", timestamp(OPEN_END)),
        span.active: F.col("deleted").isNull()})
    return closed.unionByName(_fit(lookup(added), dim))


def scd2_split(dim: DataFrame, parent_changes: DataFrame, fk: str, attributes: Sequence[str], pk: str | None = None,
               changed_at: str = "last_update", span: Span = STAR_SPAN) -> DataFrame:
    """SCD-4: a parent changed strictly inside a version splits that version in two.

    The earlier part keeps its row key and becomes inactive; the later part takes the
    new attributes, the old end and the old activity, and awaits a new row key. Any
    version may be split, also a historical one. One join, then one or two rows each.
    """
    changes = parent_changes.select(fk, F.col(changed_at).alias("_at"), *[F.col(a).alias(f"_new_{a}") for a in attributes])
    inside = (F.col("_at") > F.col(span.start)) & (F.col("_at") < F.col(span.end))

    def row(**replaced: Column) -> Column:
        return F.struct(*[replaced.get(c, F.col(c)).cast(t).alias(c) for c, t in dim.dtypes])

    later = {a: F.col(f"_new_{a}") for a in attributes} | {span.start: F.col("_at")}
    if pk:
        later[pk] = F.lit(None)
    parts = F.when(inside, F.array(row(**{span.end: F.col("_at"), span.active: F.lit(False)}), row(**later))).otherwise(
        F.array(row()))
    return dim.join(changes, fk, "left").select(F.explode(parts).alias("_row")).select("_row.*")


def scd2_hash(dim: DataFrame, snapshot: DataFrame, key: str, load_ts: str, changed_at: str = "last_update",
              span: Span = CORP_SPAN, hash_column: str = "hash") -> DataFrame:
    """SCD-5: a full snapshot against a dimension, by hash of the whole row.

    Keys without any version get one. Live keys missing in the snapshot end at the
    load time (also discs and staff, for which the missing row has no deletion time to
    give). Live keys with another hash end at the change and continue from there. A
    key that comes back after it ended is not opened again.

    One full outer join of the live versions with the snapshot gives each of them one or two rows. History passes by: only
    its keys are looked at, and of these only such as a filter of the keys without a live version lets through.
    """
    live, now = is_live(span), F.col("_now")
    current = snapshot.withColumn(hash_column, row_hash(snapshot.columns))
    opened, history = dim.filter(live), dim.filter(~live)
    unmatched = snapshot.select(key).join(opened.select(key), key, "left_anti")
    ended = history.filter(known_filter(unmatched, key)).select(key).distinct().withColumn("_ended", F.lit(True))
    given = current.join(ended, key, "left").select(key, F.struct("*").alias("_now"))
    both = opened.select(key, F.struct("*").alias("_was")).join(given, key, "full_outer")

    was = F.col("_was")
    changed = was[hash_column] != now[hash_column]
    end = F.when(now.isNull(), timestamp(load_ts)).when(changed, now[changed_at])

    def row(values: Mapping[str, Column]) -> Column:
        return F.struct(*[values[c].cast(t).alias(c) for c, t in dim.dtypes])

    kept = row({c: was[c] for c in dim.columns} | {
        span.end: F.coalesce(end, was[span.end]), span.active: end.isNull()})
    attributes = {c: now[c] if c in current.columns else F.lit(None) for c in dim.columns}
    added = row(attributes | {span.start: F.when(was.isNull(), timestamp(OPEN_START)).otherwise(now[changed_at]),
                              span.end: timestamp(OPEN_END), span.active: F.lit(True)})
    rows = (F.when(was.isNotNull() & changed, F.array(kept, added)).when(was.isNotNull(), F.array(kept))
            .when(now["_ended"].isNull(), F.array(added)))
    return history.unionByName(both.select(F.inline(rows)))
