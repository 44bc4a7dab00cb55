"""Aggregate marts. Sums are taken per key before each join, so that a popular
film, disc or day is one row by the time it is shuffled."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.hashing import packed

_TOTAL = "decimal(18,2)"


def star_sales_by_date(fact: DataFrame, calendar: DataFrame, current_only: bool = False) -> DataFrame:
    """MRT-1: amount per day. Counts every version of a payment unless `current_only`."""
    rows = fact.filter("is_active") if current_only else fact
    daily = rows.groupBy(F.col("payment_date_fk").alias("date_pk")).agg(F.sum("amount").alias("amount"))
    return dated(daily, calendar)


def dated(sums: DataFrame, calendar: DataFrame) -> DataFrame:
    """MRT-1 from sums per day (date_pk, amount)."""
    return sums.join(calendar.select("date_pk", "day_of_month", "month_name", "year_actual"), "date_pk").select(
        F.concat_ws(" ", "day_of_month", "month_name", "year_actual").alias("date_title"),
        F.col("date_pk").alias("date_sort"), F.col("amount").cast(_TOTAL).alias("amount"))


def star_sales_by_film(fact: DataFrame, dim_inventory: DataFrame, current_only: bool = False) -> DataFrame:
    """MRT-2: amount per film title of the disc version that each payment points at."""
    rows = fact.filter("is_active") if current_only else fact
    per_disc = rows.groupBy(F.col("inventory_fk").alias("inventory_pk")).agg(F.sum("amount").alias("amount"))
    return per_disc.join(dim_inventory.select("inventory_pk", "title"), "inventory_pk").groupBy(
        F.col("title").alias("film_title")).agg(F.sum("amount").cast(_TOTAL).alias("amount"))


def summed(changes: DataFrame, key: str) -> DataFrame:
    """Signed changes (`key`, amount, sign) as one row per key: number of rows and amount, both with their sign."""
    return changes.groupBy(key).agg(F.sum("sign").cast("bigint").alias("n"), F.sum(F.col("amount") * F.col("sign")).cast(_TOTAL).alias("amount"))


def by_title(delta: DataFrame, dim_inventory: DataFrame) -> DataFrame:
    """Sums per disc version (inventory_fk) as sums per film title; what a version is called never changes."""
    titles = dim_inventory.select(F.col("inventory_pk").alias("inventory_fk"), F.col("title").alias("film_title"))
    return delta.join(titles, "inventory_fk").select("film_title", "n", "amount")


def add_up(sums: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """Sums (`key`, n, amount) with further ones added to them. A key without rows left goes."""
    both = sums.unionByName(delta).groupBy(key).agg(F.sum("n").alias("n"), F.sum("amount").cast(_TOTAL).alias("amount"))
    return both.filter(F.col("n") > 0).select(*sums.columns)


def corporate_sales_by_date(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """MRT-3: amount of the live payments per day."""
    daily = fact.filter(F.col("deleted").isNull()).groupBy(F.to_date("payment_date").alias("date_actual")).agg(
        F.sum("amount").alias("amount"))
    return daily.join(calendar, "date_actual").select(
        F.col("date_id").alias("sales_date_id"),
        F.concat_ws(" ", "day_of_month", "month_name", "year").alias("sales_date_title"),
        F.col("amount").cast("double").alias("amount"))


def corporate_sales_by_film(payment: DataFrame, rental: DataFrame, dim_inventory: DataFrame, dim_film: DataFrame,
                            current_only: bool = False) -> DataFrame:
    """MRT-4: amount per title over all versions of discs and films, deleted payments
    included; `current_only` counts live payments and live versions."""
    if current_only:
        payment = payment.filter(F.col("deleted").isNull())
        dim_inventory, dim_film = dim_inventory.filter("is_active"), dim_film.filter("is_active")
    amount = F.sum("amount").alias("amount")
    per_rental = payment.groupBy("rental_id").agg(amount)
    per_disc = per_rental.join(rental.select("rental_id", "inventory_id"), "rental_id").groupBy("inventory_id").agg(amount)
    per_film = per_disc.join(dim_inventory.select("inventory_id", "film_id"), "inventory_id").groupBy("film_id").agg(amount)
    return per_film.join(dim_film.select("film_id", "title"), "film_id").groupBy(F.col("title").alias("film_title")).agg(
        F.sum("amount").cast(_TOTAL).alias("amount"))


def rented_film(hub_film: DataFrame, sat_film_static: DataFrame, link_film_inventory: DataFrame, hub_inventory: DataFrame,
                link_rental_inventory: DataFrame, hub_rental: DataFrame, current_only: bool = False) -> DataFrame:
    """MRT-5: rentals per title over all satellite versions, most rented first.

    The hubs only have to contain the key, so they are semi-joins, and the rentals are
    counted per disc, then per film, before titles are joined. Keys that come with each rental are packed.
    """
    if current_only:
        sat_film_static = sat_film_static.filter(F.col("load_end_date").isNull())
    quantity = F.sum("quantity").alias("quantity")
    rented = link_rental_inventory.select(packed(F.col("hub_rental_hash_key")).alias("_rental"), packed(F.col("hub_inventory_hash_key")).alias("_disc"))
    rentals = hub_rental.select(packed(F.col("hub_rental_hash_key")).alias("_rental"))
    per_packed = rented.join(rentals, "_rental", "left_semi").groupBy("_disc").agg(F.count(F.lit(1)).alias("quantity"))
    # the hub's keys are only looked for, so they come once
    discs = hub_inventory.select("hub_inventory_hash_key").distinct().withColumn("_disc", packed(F.col("hub_inventory_hash_key")))
    per_disc = discs.join(per_packed, "_disc").select("hub_inventory_hash_key", "quantity")
    per_film = per_disc.join(link_film_inventory.select("hub_inventory_hash_key", "hub_film_hash_key"),
                             "hub_inventory_hash_key").groupBy("hub_film_hash_key").agg(quantity).join(
        hub_film, "hub_film_hash_key", "left_semi")
    return per_film.join(sat_film_static.select("hub_film_hash_key", "title"), "hub_film_hash_key").groupBy(
        F.col("title").alias("film_title")).agg(quantity).orderBy(F.desc("quantity"))


def register_reader(spark: SparkSession, mart: DataFrame, function: str, columns: str) -> None:
    """UDF-3: a table function of that name over a mart, for SQL users. `columns` are its names and types.

    The view below it has a name of its own, so functions of other names and later loads don't touch it.
    """
    view = f"{function}_{uuid.uuid4().hex}"
    mart.createOrReplaceTempView(view)
    shown = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in (c.split() for c in columns.split(", ")))
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {function}() RETURNS TABLE ({columns}) RETURN SELECT {shown} FROM {view}")
