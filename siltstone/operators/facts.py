"""Versioned facts: a fact row has validity columns like a dimension row.

Order inside a load, as in the model: soft deletes, new rows, changes that need no
history (written in place), changes that do (close and append). Which keys are new and which
are written in place is decided on the state before anything is appended.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.dates import OPEN_END, OPEN_START, date_key, timestamp
from siltstone.operators.asof import as_of_join
from siltstone.operators.filters import bits_for, known_filter
from siltstone.operators.scd import STAR_SPAN, Span, _fit, _seen, is_live
from siltstone.session import materialize

def _resolve(staged: DataFrame, dim_inventory: DataFrame, dim_staff: DataFrame, closed: str, span: Span, unmatched: bool = False) -> DataFrame:
    """Staged facts with the row keys of the disc and staff versions valid at their last update."""
    rows = as_of_join(staged, dim_inventory, "inventory_id", "last_update",
                      {"inventory_pk": "inventory_fk", span.start: "_inventory_from"}, closed, span, unmatched)
    return as_of_join(rows, dim_staff, "staff_id", "last_update", {"staff_pk": "staff_fk", span.start: "_staff_from"},
                      closed, span, unmatched)


def _known_to(staged: DataFrame, key: str) -> Column:
    """A filter of the staged keys, with bits for all of them, that is never NULL."""
    return F.coalesce(known_filter(staged, key, bits_for(staged.count())), F.lit(False))


def _versioned(rows: DataFrame, first: Column, span: Span) -> DataFrame:
    return rows.withColumns({
        span.start: F.when(first, timestamp(OPEN_START)).otherwise(F.col("last_update")),
        span.end: F.coalesce("deleted", timestamp(OPEN_END)), span.active: F.col("deleted").isNull()})


def load_fact_payment(fact: DataFrame, staged: DataFrame, dim_inventory: DataFrame, dim_staff: DataFrame,
                      calendar: DataFrame, closed: str = "both", span: Span = STAR_SPAN) -> DataFrame:
    """FCT-1: the fact after a load; see `merge_payments`."""
    past, merged = merge_payments(fact, staged, dim_inventory, dim_staff, calendar, closed, span)
    return past.unionByName(merged.select(*fact.columns))


def merge_payments(fact: DataFrame, staged: DataFrame, dim_inventory: DataFrame, dim_staff: DataFrame, calendar: DataFrame,
                   closed: str = "both", span: Span = STAR_SPAN) -> tuple[DataFrame, DataFrame]:
    """FCT-1 in two parts: the rows that pass by as they are, and those a load may touch, as they become, with `_was` (the row before
    the load, NULL for a new one). Amount, payment date and rental are historised; disc and staff are not.

    A staged payment equal in the historised columns to the version valid at its last
    update only has that version's disc and staff keys rewritten. If several versions of
    a disc or member of staff match (a border), the one that starts last is written.

    Versions and staged rows, with what these resolve to, are dealt by payment once; what a payment's rows have to know of each
    other, they read from windows over it. Two kinds of rows are told apart before that and pass by: those whose payment a
    filter of the staged ones doesn't know, and history that ended before the oldest staged change, which can't be valid at any.
    Of such history of staged payments only the keys are looked at.
    """
    key = "payment_id"
    oldest = staged.agg(F.min("last_update")).scalar()
    empty = fact.isEmpty()  # then there is nothing to find among the staged rows, which are read once, nor to write in place
    known = F.lit(False) if empty else _known_to(staged, key)
    recent = is_live(span) | F.coalesce(F.col(span.end) >= oldest, F.lit(False))
    reached = known & recent
    past = fact.filter(~reached)
    ended = fact.filter(known & ~recent).select(key).distinct().withColumn("_ended", F.lit(True))
    days = calendar.select(F.col("date_pk").alias("payment_date_fk"), F.lit(True).alias("_in_calendar"))
    read = staged.select(key, "inventory_id", "staff_id", "rental_id", "amount", date_key(F.col("payment_date")).alias("payment_date_fk"),
                         "last_update", "deleted")
    resolved = _resolve(read, dim_inventory, dim_staff, closed, span, unmatched=True).join(days, "payment_date_fk", "left")
    came = resolved.select(key, F.struct(*[c for c in resolved.columns if c not in (key, "inventory_id", "staff_id")]).alias("_new"))
    rows = fact.filter(reached).select(key, F.struct(*fact.columns).alias("_row")).unionByName(came, True).unionByName(ended, True)
    rows = rows.repartition(key)  # before the windows' arguments, which would travel beside the rows that they come from

    payment, row, new, mark = Window.partitionBy(key), F.col("_row"), F.col("_new"), F.col("_mark")
    # a staged row without a valid disc or member of staff adds nothing, but it marks its payment
    found = new["_inventory_from"].isNotNull() & new["_staff_from"].isNotNull()
    rows = rows.withColumns({
        "_mark": F.max(F.when(new.isNotNull(), F.struct(
            new["deleted"].alias("gone_at"), new["last_update"].alias("at"), new["amount"], new["rental_id"],
            new["payment_date_fk"].alias("day")))).over(payment),
        "_known": F.max(row.isNotNull() | F.col("_ended").isNotNull()).over(payment),
        "_last_inventory": F.max(F.when(found, F.struct(new["_inventory_from"], new["inventory_fk"].alias("fk")))).over(payment)["fk"],
        "_last_staff": F.max(F.when(found, F.struct(new["_staff_from"], new["staff_fk"].alias("fk")))).over(payment)["fk"]})
    live, gone = row[span.active].eqNullSafe(F.lit(True)), mark["gone_at"].isNotNull()
    end = F.when(live & gone, mark["gone_at"]).otherwise(row[span.end])
    valid = mark["at"].between(row[span.start], end)
    equal = valid & (row["amount"] == mark["amount"]) & (row["payment_date_fk"] == mark["day"]) & (row["rental_id"] == mark["rental_id"])
    rows = rows.withColumn("_in_place", F.lit(False) if empty else F.max(F.coalesce(equal, F.lit(False))).over(payment))
    in_place, first = F.col("_in_place"), ~F.col("_known")

    rewritten = in_place & F.col("_last_inventory").isNotNull() & valid
    closes = live & mark.isNotNull() & ~gone & ~in_place
    kept = {"inventory_fk": F.when(rewritten, F.col("_last_inventory")).otherwise(row["inventory_fk"]),
            "staff_fk": F.when(rewritten, F.col("_last_staff")).otherwise(row["staff_fk"]),
            span.end: F.when(closes, mark["at"]).otherwise(end),
            span.active: F.when((live & gone) | closes, F.lit(False)).otherwise(row[span.active])}
    # A new row is itself valid at its last update unless it was deleted before that.
    settles = first & (new["last_update"] <= F.coalesce(new["deleted"], timestamp(OPEN_END)))
    added = {key: F.col(key), "rental_id": new["rental_id"], "amount": new["amount"], "payment_date_fk": new["payment_date_fk"],
             "inventory_fk": F.when(settles, F.col("_last_inventory")).otherwise(new["inventory_fk"]),
             "staff_fk": F.when(settles, F.col("_last_staff")).otherwise(new["staff_fk"]),
             span.start: F.when(first, timestamp(OPEN_START)).otherwise(new["last_update"]),
             span.end: F.coalesce(new["deleted"], timestamp(OPEN_END)), span.active: new["deleted"].isNull()}
    is_added = found & (first | (~in_place & new["deleted"].isNull())) & new["_in_calendar"]
    shaped = [F.when(row.isNotNull(), kept.get(c, row[c])).otherwise(added.get(c, F.lit(None))).cast(t).alias(c) for c, t in fact.dtypes]
    return past, rows.filter(row.isNotNull() | is_added).select(*shaped, row.alias("_was"))


def signed_changes(merged: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(`columns`, sign) of the rows that a load added or changed in these columns: +1 as they become, -1 as they were."""
    now, was = F.struct(*columns), F.struct(*[F.col("_was")[c].alias(c) for c in columns])
    out = F.when(F.col("_was").isNull(), F.array(F.struct(now.alias("row"), F.lit(1).alias("sign")))).when(
        ~now.eqNullSafe(was), F.array(F.struct(now.alias("row"), F.lit(1).alias("sign")), F.struct(was.alias("row"), F.lit(-1).alias("sign"))))
    return merged.select(F.inline(out)).select("row.*", "sign")


def load_fact_rental(fact: DataFrame, staged: DataFrame, dim_inventory: DataFrame, dim_staff: DataFrame,
                     calendar: DataFrame, closed: str = "both", span: Span = STAR_SPAN,
                     save: Callable[[DataFrame, str], DataFrame] = materialize) -> DataFrame:
    """FCT-2: a return date that merely arrives is written in place; any other change is historised."""
    key = "rental_id"
    marks = staged.filter(F.col("return_date").isNotNull() & F.col("deleted").isNull()).select(
        key, "inventory_id", "staff_id", date_key(F.col("rental_date")).alias("rental_date_fk"))
    discs = dim_inventory.select(F.col("inventory_pk").alias("inventory_fk"), "inventory_id")
    people = dim_staff.select(F.col("staff_pk").alias("staff_fk"), "staff_id")
    returned = (fact.filter(is_live(span) & F.col("return_date_fk").isNull())
                .select(key, "rental_date_fk", "inventory_fk", "staff_fk").join(marks, [key, "rental_date_fk"])
                .join(discs, ["inventory_fk", "inventory_id"]).join(people, ["staff_fk", "staff_id"])
                .select(key).distinct().withColumn("_returned", F.lit(True)))
    days = calendar.select("date_pk")
    first, in_place = F.col("_first"), F.col("_in_place")
    state = save(
        staged.join(_seen(fact, staged, key), key, "left").join(returned, key, "left").withColumns({
            "_first": F.col("_seen").isNull(), "_in_place": F.coalesce("_returned", F.lit(False)),
            "_return_day": date_key(F.col("return_date"))})
        .join(days.withColumnRenamed("date_pk", "return_date_fk"), F.col("_return_day") == F.col("return_date_fk"), "left")
        .drop("_seen", "_returned", "_return_day"), "rentals")

    added = state.filter(first | (~in_place & F.col("deleted").isNull())).withColumn(
        "rental_date_fk", date_key(F.col("rental_date")))
    added = _resolve(added, dim_inventory, dim_staff, closed, span).join(
        days.withColumnRenamed("date_pk", "rental_date_fk"), "rental_date_fk")
    added = _versioned(added, first, span)

    # Only live rows of staged rentals can change, so history and, but for a few, the others are not joined.
    reached = is_live(span) & (F.lit(False) if fact.isEmpty() else _known_to(staged, key))
    actions = state.filter(~first).select(key, F.col("deleted").alias("_gone_at"), F.col("last_update").alias("_at"),
                                          "_in_place", F.col("return_date_fk").alias("_return_fk"))
    gone = F.col("_gone_at").isNotNull()
    closes = F.col("_gone_at").isNull() & ~in_place
    updated = fact.filter(reached).join(actions, key, "left").select(*[{
        "return_date_fk": F.when(in_place, F.coalesce("_return_fk", "return_date_fk")).otherwise(F.col("return_date_fk")),
        span.end: F.when(gone, F.col("_gone_at")).when(closes, F.col("_at")).otherwise(F.col(span.end)),
        span.active: F.when(gone | closes, F.lit(False)).otherwise(F.lit(True)),
    }.get(c, F.col(c)).alias(c) for c in fact.columns])
    return fact.filter(~reached).unionByName(updated).unionByName(_fit(added, fact))
