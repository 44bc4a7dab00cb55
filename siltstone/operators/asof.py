"""As-of joins: facts meet the version that was valid at their time.

A key with few versions is an equality join whose condition holds the interval: the facts are dealt by their key once, or not at
all where the versions are small enough to broadcast, and a hot key is split like in any other join. Keys with more versions than
that go another way, so that no fact is compared with many of them: their facts and version starts are sorted into one stream by
key and time, over all tasks and written once. Inside a partition the last version is carried forward; a partition begins with the
last version of those before it, one row for each. So the work of a task is a slice of the stream, however many versions or facts a
key has. What a version covers beyond the start of its successor comes on top:
a single moment (both ends of an interval count) by an equality join, more than that (versions that
overlap, which loads in order never make) by a join on the key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.operators.scd import STAR_SPAN, Span
from siltstone.session import materialize

FEW = 8  # versions of a key that each of its facts may be compared with
MANY = 500_000  # versions that are never broadcast, however small their files are
_VERSION, _FACT = 0, 1
# A version's end breaks ties of starts, a hash those of whole versions; it also parts facts of one key and moment.
_ORDER = ("_key", "_at", "_kind", "_v._end", "_tie")


@dataclass(frozen=True)
class _Stream:
    """The written stream (_key, _at, _kind, _v, _f, _tie, _part, _id) and what was asked of it."""

    rows: DataFrame
    closed: str

    @property
    def versions(self) -> DataFrame:
        return self.rows.filter(F.col("_kind") == _VERSION)

    @property
    def facts(self) -> DataFrame:
        return self.rows.filter(F.col("_kind") == _FACT).select("_key", "_at", "_f", "_id")

    def before_end(self, end: Column) -> Column:
        return F.col("_at") <= end if self.closed == "both" else F.col("_at") < end


def _stream(facts: DataFrame, dim: DataFrame, key: str, at: str, columns: dict[str, str], closed: str, span: Span) -> _Stream:
    version = F.struct(F.col(span.end).alias("_end"), *[F.col(c).alias(n) for c, n in columns.items()])
    v = dim.select(F.col(key).alias("_key"), F.col(span.start).alias("_at"), F.lit(_VERSION).alias("_kind"), version.alias("_v"))
    f = facts.select(F.col(key).alias("_key"), F.col(at).alias("_at"), F.lit(_FACT).alias("_kind"), F.struct(*facts.columns).alias("_f"))
    rows = v.unionByName(f, allowMissingColumns=True).filter(F.col("_key").isNotNull() & F.col("_at").isNotNull()).withColumn(
        "_tie", F.xxhash64("_v", "_f"))
    placed = rows.sort(*_ORDER).withColumns({"_part": F.spark_partition_id(), "_id": F.monotonically_increasing_id()})
    return _Stream(materialize(placed, "as-of"), closed)


def _neighbour(parts: DataFrame, value: str, forward: bool) -> Column:
    """Per partition of the stream, the value of the nearest one before (or after) it that has any. One row per partition is all
    there is to order, so this window may run in one task."""
    order = F.asc("_part") if forward else F.desc("_part")
    return F.last(value, ignorenulls=True).over(Window.partitionBy(F.lit(0)).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))


def _carried(stream: _Stream) -> DataFrame:
    """The facts with the version that starts last before or at them (`_v`, `_start`; NULL if the key has none by then)."""
    version = F.when(F.col("_kind") == _VERSION, F.struct("_key", "_at", "_v"))
    so_far = Window.partitionBy("_part").orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = stream.rows.withColumn("_last", F.last(version, ignorenulls=True).over(so_far)).filter(F.col("_kind") == _FACT)
    parts = stream.rows.groupBy("_part").agg(F.max_by(version, F.when(F.col("_kind") == _VERSION, F.struct(*_ORDER))).alias("_ends_with"))
    handed = parts.select("_part", _neighbour(parts, "_ends_with", True).alias("_handed"))
    found = own.join(F.broadcast(handed), "_part").withColumn("_found", F.coalesce("_last", "_handed"))
    same = F.col("_found._key") == F.col("_key")
    return found.select("_key", "_at", "_f", "_id", F.when(same, F.col("_found._v")).alias("_v"), F.when(same, F.col("_found._at")).alias("_start"))


def _reaching(stream: _Stream) -> DataFrame:
    """Versions that reach the start of their successor (`_next`) or beyond it."""
    start = F.struct("_key", "_at")
    parts = stream.rows.groupBy("_part").agg(F.min(F.when(F.col("_kind") == _VERSION, start)).alias("_begins_with"))
    following = parts.select("_part", _neighbour(parts, "_begins_with", False).alias("_following"))
    rows = stream.versions.withColumn("_after", F.lead(start).over(Window.partitionBy("_part").orderBy(*_ORDER))).join(
        F.broadcast(following), "_part").withColumn("_after", F.coalesce("_after", "_following"))
    return rows.filter(F.col("_after._key") == F.col("_key")).select(
        F.col("_key").alias("_vkey"), F.col("_after._at").alias("_next"), "_v").filter(F.col("_v._end") >= F.col("_next"))


def _overlapped(stream: _Stream, reaching: DataFrame) -> DataFrame:
    """Facts with the earlier versions that are still valid after the start of a later one.

    The facts are read within the bounds of such versions, which the scan gets at run time; where there are none it reads nothing.
    """
    longer = reaching.filter(F.col("_v._end") > F.col("_next"))
    low_key, high_key, low, high = (longer.agg(c).scalar() for c in (F.min("_vkey"), F.max("_vkey"), F.min("_next"), F.max("_v._end")))
    facts = stream.facts.filter(F.col("_key").between(low_key, high_key) & F.col("_at").between(low, high))
    return facts.join(longer, F.col("_key") == F.col("_vkey")).filter((F.col("_at") >= F.col("_next")) & stream.before_end(F.col("_v._end"))).select(
        "_f", "_id", "_v")


def _matches(stream: _Stream) -> tuple[DataFrame, DataFrame]:
    """(_f, _id, _v) of each fact and version that meet: by the carried versions, and by all others."""
    carried, reaching = _carried(stream), _reaching(stream)
    main = carried.filter(stream.before_end(F.col("_v._end"))).select("_f", "_id", "_v")
    others = _overlapped(stream, reaching)
    if stream.closed == "both":  # a fact at the very start of a version also meets those that end there
        ending = reaching.filter(F.col("_v._end") == F.col("_next")).select("_vkey", "_next", F.col("_v").alias("_other"))
        on_border = carried.filter(F.col("_at") == F.col("_start")).drop("_v")
        meets = (F.col("_key") == F.col("_vkey")) & (F.col("_at") == F.col("_next"))
        others = others.unionByName(on_border.join(ending, meets).select("_f", "_id", F.col("_other").alias("_v")))
    return main, others


def _of_few(facts: DataFrame, dim: DataFrame, key: str, at: str, columns: dict[str, str], closed: str, span: Span, many: bool, how: str) -> DataFrame:
    """Facts joined with the versions of their key that hold their time; `dim` has few versions of each key, but may have `many` keys."""
    versions = dim.select(F.col(key).alias("_vkey"), F.col(span.start).alias("_vstart"), F.col(span.end).alias("_vend"),
                          *[F.col(c).alias(f"_v_{n}") for c, n in columns.items()])
    versions = versions.hint("merge") if many else versions
    ends = F.col(at) <= F.col("_vend") if closed == "both" else F.col(at) < F.col("_vend")
    return facts.join(versions, (F.col(key) == F.col("_vkey")) & (F.col(at) >= F.col("_vstart")) & ends, how).select(
        *facts.columns, *[F.col(f"_v_{n}").alias(n) for n in columns.values()])


def as_of_join(facts: DataFrame, dim: DataFrame, key: str, at: str, columns: dict[str, str], closed: str = "both", span: Span = STAR_SPAN,
               unmatched: bool = False) -> DataFrame:
    """ASOF-1: facts with `columns` (dimension column → new name) of the valid version.

    Inner: a fact without a valid version drops, as does one without a key or a time; `as_of_misses` lists them.
    `closed="both"` counts both ends, so a fact exactly on the border of two versions meets both; `closed="left"` counts
    the start only. Versions may have gaps, no length, equal starts, or overlap: a fact meets every one that holds its time.

    With `unmatched`, facts without a valid version come too, with NULLs; so do all facts whose key has more than a few
    versions, beside their matches.

    How many versions there are, of one key and in all, is asked first.
    """
    counts = dim.filter(F.col(key).isNotNull()).groupBy(key).count()
    most, total = counts.agg(F.coalesce(F.max("count"), F.lit(0)), F.coalesce(F.sum("count"), F.lit(0))).first()
    how = "left" if unmatched else "inner"
    if most <= FEW:
        return _of_few(facts, dim, key, at, columns, closed, span, total > MANY, how)
    crowded = materialize(counts.filter(F.col("count") > FEW).select(key), "crowded")
    marked = dim.join(crowded.withColumn("_crowded", F.lit(True)), key, "left").select(*dim.columns, "_crowded")
    few = _of_few(facts, marked.filter(F.col("_crowded").isNull()), key, at, columns, closed, span, total > MANY, how)
    facts, dim = facts.join(crowded, key, "left_semi").select(*facts.columns), marked.filter("_crowded").select(*dim.columns)
    main, others = _matches(_stream(facts, dim, key, at, columns, closed, span))
    return few.unionByName(main.unionByName(others).select("_f.*", *[F.col(f"_v.{n}").alias(n) for n in columns.values()]))


# Why a fact meets no version.
NO_KEY, NO_TIME, UNKNOWN, EARLY, GAP, LATE = "no key", "no time", "unknown key", "before the first version", "between two versions", "after the last version"


def as_of_misses(facts: DataFrame, dim: DataFrame, key: str, at: str, closed: str = "both", span: Span = STAR_SPAN) -> DataFrame:
    """DQ-5 for as-of joins: the facts that `as_of_join` drops, each once, with the `reason`.

    Together with the facts that it keeps these are all facts. Only the misses meet the first and last start of their key.
    """
    stream = _stream(facts, dim, key, at, {}, closed, span)
    _, others = _matches(stream)
    missed = _carried(stream).filter(~F.coalesce(stream.before_end(F.col("_v._end")), F.lit(False))).join(others.select("_id"), "_id", "left_anti")
    starts = dim.filter(F.col(span.start).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min(span.start).alias("_first"), F.max(span.start).alias("_final"))
    reason = F.when(F.col("_first").isNull(), UNKNOWN).when(F.col("_at") < F.col("_first"), EARLY).when(F.col("_at") < F.col("_final"), GAP).otherwise(LATE)
    found = missed.join(starts, "_key", "left").select("_f.*", reason.alias("reason"))
    absent = F.when(F.col(key).isNull(), NO_KEY).otherwise(NO_TIME)
    return found.unionByName(facts.filter(F.col(key).isNull() | F.col(at).isNull()).withColumn("reason", absent))
