"""Generators of rentals and of changes to them, to make incremental loads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.dates import timestamp


def drawn(seed: int, row: Column | str, purpose: str) -> Column:
    """A number from 0 (included) to 1 (not included) that seed, row and purpose decide alone.

    Unlike a generator that counts the rows of a partition it gives a row the same number however the rows are dealt, and
    each purpose a number of its own.
    """
    digest = F.md5(F.concat_ws("/", F.lit(str(seed)), F.lit(purpose), F.col(row) if isinstance(row, str) else row).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def synthetic_rentals(rentals: DataFrame, inventory: DataFrame, films: DataFrame, customers: DataFrame, staff: DataFrame,
                      n: int, day: str | None = None, seed: int = 0, base: int = 1,
                      draw: Callable[[Column], Column] | None = None) -> DataFrame:
    """GEN-1: n rentals of one day, by default the day after the last rental.

    One random number per row picks disc, customer and member of staff alike, as
    floor(r * count) + base; ids must be dense from `base`. `draw` gives the number from
    the row id instead of `drawn`. A disc without film has no return date.
    """
    def total(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1))).scalar()

    def pick(df: DataFrame) -> Column:
        return (F.floor(F.col("_r") * total(df)) + base).cast("bigint")

    rented = F.lit(day).cast("date") if day else F.date_add(rentals.agg(F.to_date(F.max("rental_date"))).scalar(), 1)
    rows = rentals.sparkSession.range(n).withColumn("_r", draw(F.col("id")) if draw else drawn(seed, "id", "rental")).select(
        "id", rented.alias("rental_date"), pick(inventory).alias("inventory_id"), pick(customers).alias("customer_id"),
        pick(staff).alias("staff_id"))
    durations = inventory.select("inventory_id", "film_id").join(films.select("film_id", "rental_duration"), "film_id").select(
        "inventory_id", F.col("rental_duration").cast("int").alias("_days"))
    return rows.join(durations, "inventory_id", "left").select(
        "id", F.col("rental_date").cast("timestamp_ntz").alias("rental_date"), "inventory_id", "customer_id",
        F.date_add("rental_date", F.col("_days")).cast("timestamp_ntz").alias("return_date"), "staff_id")


# Shares of the rows that each kind of change takes, in this order.
SHARES = {"update": 0.05, "delete": 0.02, "insert": 0.03, "late": 0.02, "repeat": 0.01}


def synthetic_changes(rentals: DataFrame, inventory: DataFrame, customers: DataFrame, staff: DataFrame, load_ts: str, seed: int = 0,
                      base: int = 1, shares: dict[str, float] | None = None) -> DataFrame:
    """GEN-1 as a feed: the changes of the day before `load_ts`, in the columns of a rental with `last_update`, `deleted` and `change`.

    update: another disc, and a return 1 to 10 days after the rental. delete: the row as it was, soft-deleted. insert: a new rental of
    that day, its id above all known ones, not yet returned. late: an update that was made up to three days earlier, before
    the load that should have had it. repeat: an update that comes twice. Which rows change, and how, is drawn from the
    row's id, so the feed is the same on any number of partitions. Ids of discs, customers and staff must be dense from `base`.
    """
    def total(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1))).scalar()

    def pick(df: DataFrame, purpose: str) -> Column:
        return (F.floor(drawn(seed, "rental_id", purpose) * total(df)) + base).cast("bigint")

    def days(count: Column) -> Column:
        return F.make_dt_interval(count.cast("int"))

    kinds, upto = F.when(F.lit(False), ""), 0.0
    for name, share in (shares or SHARES).items():
        upto += share
        kinds = kinds.when(F.col("_kind") < upto, F.lit(name))
    day = timestamp(load_ts) - days(F.lit(1))
    at = day + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.floor(drawn(seed, "rental_id", "second") * 86400).cast("decimal(18,6)"))
    changed, new = F.col("change").isin("update", "late", "repeat"), F.col("change") == "insert"
    late = F.when(F.col("change") == "late", days(F.floor(drawn(seed, "rental_id", "late") * 3) + 1)).otherwise(days(F.lit(0)))
    rows = rentals.withColumn("_kind", drawn(seed, "rental_id", "kind")).withColumn("change", kinds).filter(F.col("change").isNotNull())
    out = rows.select(
        F.when(new, F.col("rental_id") + rentals.agg(F.max("rental_id")).scalar() + 1).otherwise(F.col("rental_id")).alias("rental_id"),
        F.when(new, day).otherwise(F.col("rental_date")).alias("rental_date"),
        F.when(changed | new, pick(inventory, "inventory")).otherwise(F.col("inventory_id")).alias("inventory_id"),
        F.when(new, pick(customers, "customer")).otherwise(F.col("customer_id")).alias("customer_id"),
        F.when(changed, F.col("rental_date") + days(F.floor(drawn(seed, "rental_id", "return") * 10) + 1)).when(~new, F.col("return_date")).alias("return_date"),
        F.when(new, pick(staff, "staff")).otherwise(F.col("staff_id")).alias("staff_id"),
        (at - late).alias("last_update"), F.when(F.col("change") == "delete", at).alias("deleted"), "change")
    times = F.when(F.col("change") == "repeat", 2).otherwise(1)
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), times))).drop("_copy")
