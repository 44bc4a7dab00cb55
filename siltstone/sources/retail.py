"""A film-rental source derived from the order tables, in two load batches.

The rules are those of FIXTURES.md: key arithmetic decides which rows are new,
changed, soft-deleted, hard-deleted or merely touched in the second batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.session import materialize

FIRST_LOAD = "2002-01-01 00:00:00"
SECOND_LOAD = "2002-02-01 00:00:00"

_NO_STAMP = "CAST(NULL AS TIMESTAMP_NTZ)"
_BORN = {"dim": "TIMESTAMP_NTZ '2001-12-01 00:00:00'", "fact": "TIMESTAMP_NTZ '2001-12-15 00:00:00'"}
_CHANGED = {"dim": "TIMESTAMP_NTZ '2002-01-10 00:00:00'", "film": "TIMESTAMP_NTZ '2002-01-12 00:00:00'",
            "fact": "TIMESTAMP_NTZ '2002-01-20 00:00:00'"}
_GONE = "TIMESTAMP_NTZ '2002-01-15 00:00:00'"

_FILM = ["film_id", "title", "description", "CAST(1990 + size % 30 AS INT) AS release_year", "CAST(size * 3 AS INT) AS length",
         "size AS rental_duration", "CAST(price AS DECIMAL(12,2)) AS rental_rate",
         "CAST(price * 2 AS DECIMAL(12,2)) AS replacement_cost", "rating"]
_INVENTORY = ["p_partkey AS inventory_id", "CAST(FLOOR(p_partkey / 10) AS BIGINT) AS film_id",
              "CAST(p_partkey % 25 AS BIGINT) AS store_id"]
_RENTAL = ["o_orderkey AS rental_id", "o_orderdate AS rental_date", "l_partkey AS inventory_id",
           "o_custkey AS customer_id", "l_shipdate AS return_date", "l_suppkey AS staff_id"]
_PAYMENT = ["o_orderkey AS payment_id", "o_custkey AS customer_id", "COALESCE(l_suppkey, 0L) AS staff_id",
            "o_orderkey AS rental_id", "CAST(o_totalprice AS DECIMAL(12,2)) AS amount", "o_orderdate AS payment_date"]
_STAFF = ["s_suppkey AS staff_id", "s_name AS first_name", "s_name AS last_name",
          "CAST(s_nationkey AS BIGINT) AS address_id", "CAST(s_nationkey AS BIGINT) AS store_id"]
_ADDRESS = ["CAST(n_nationkey AS BIGINT) AS address_id", "n_name AS address", "n_name AS district",
            "CAST(n_regionkey AS BIGINT) AS city_id"]
_CITY = ["CAST(r_regionkey AS BIGINT) AS city_id", "r_name AS city"]
_STORE = ["CAST(n_nationkey AS BIGINT) AS store_id", "CAST(n_nationkey % 10 AS BIGINT) AS manager_staff_id",
          "CAST(n_nationkey AS BIGINT) AS address_id"]


class RetailSource:
    """`RetailSource(spark, folder, batch)("film")` is the film table as of that batch."""

    def __init__(self, spark: SparkSession, folder: str, batch: int = 2, opened: dict[str, DataFrame] | None = None):
        self.spark, self.folder, self.batch = spark, folder, batch
        self._opened = {} if opened is None else opened

    def other_batch(self) -> RetailSource:
        """The other batch over the same opened tables (each table's footer is read once)."""
        return RetailSource(self.spark, self.folder, 3 - self.batch, self._opened)

    def with_stored_facts(self, *names: str) -> RetailSource:
        """The facts as stored tables, as a real source has them, for use in several loads.

        Both facts come from one join of orders and line items, written once.
        """
        if {"payment", "rental"} <= set(names):
            lines = self._by_order("l_partkey", "l_suppkey", "l_shipdate").withColumn("shipped", F.lit(True))
            orders = materialize(self.raw("orders").join(lines, "o_orderkey", "left").select(
                "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", *lines.columns[1:]), "orders")
            self._opened["rental_base"] = orders.filter("shipped").selectExpr(*_RENTAL)
            self._opened["payment_base"] = orders.selectExpr(*_PAYMENT)
            return self
        for name in names:
            self._opened[f"{name}_base"] = materialize(getattr(self, f"{name}_base")(), f"{name}_base")
        return self

    def raw(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._opened[name]

    def __call__(self, name: str) -> DataFrame:
        return getattr(self, f"_{name}")()

    def _batch(self, base: DataFrame, key: str, kind: str, changes: dict[str, str], stamped: str | None = None,
               classes: str = "3, 13, 19", touched: bool = True, deletable: bool = True,
               first: dict[str, str] | None = None) -> DataFrame:
        """The rows of a batch. `key` decides the class of a row, `changes` are the second
        batch's column expressions, `first` those of the first batch."""
        if self.batch == 1:
            rows, replaced = base.where(f"{key} % 20 <> 19"), first or {}
            last_update, deleted = _BORN[kind], _NO_STAMP
        else:
            rows, replaced = base.where(f"{key} % 40 <> 6"), changes
            touch = f"WHEN {key} % 50 = 1 THEN TIMESTAMP_NTZ '{FIRST_LOAD}' " if touched else ""
            last_update = f"CASE WHEN {key} % 20 IN ({classes}) THEN {_CHANGED[stamped or kind]} {touch}ELSE {_BORN[kind]} END"
            deleted = f"CASE WHEN {key} % 25 = 4 THEN {_GONE} END"
        stamps = [f"{last_update} AS last_update"] + ([f"{deleted} AS deleted"] if deletable else [])
        return rows.selectExpr(*[f"{replaced[c]} AS {c}" if c in replaced else c for c in base.columns], *stamps)

    # -- base rows, before any batch rule

    def film_base(self) -> DataFrame:
        """A film for each ten parts, which are its discs."""
        parts = self.raw("part").groupBy(F.expr("CAST(FLOOR(p_partkey / 10) AS BIGINT)").alias("film_id")).agg(
            F.min("p_name").alias("title"), F.min("p_type").alias("description"), F.max("p_size").alias("size"),
            F.max("p_retailprice").alias("price"), F.min("p_brand").alias("rating"))
        return parts.selectExpr(*_FILM)

    def inventory_base(self) -> DataFrame:
        return self.raw("part").selectExpr(*_INVENTORY)

    def _by_order(self, *columns: str) -> DataFrame:
        """Line items reduced to one row per order, before they are joined."""
        lines = self.raw("lineitem").groupBy("l_orderkey").agg({c: "max" for c in columns})
        return lines.selectExpr("l_orderkey AS o_orderkey", *[f"`max({c})` AS {c}" for c in columns])

    def rental_base(self) -> DataFrame:
        if "rental_base" in self._opened:
            return self._opened["rental_base"]
        return self.raw("orders").join(self._by_order("l_partkey", "l_suppkey", "l_shipdate"), "o_orderkey").selectExpr(*_RENTAL)

    def payment_base(self) -> DataFrame:
        if "payment_base" in self._opened:
            return self._opened["payment_base"]
        return self.raw("orders").join(self._by_order("l_suppkey"), "o_orderkey", "left").selectExpr(*_PAYMENT)

    # -- tables of a batch

    def _film(self) -> DataFrame:
        return self._batch(self.film_base(), "film_id", "dim", {
            "rental_rate": "CAST(CASE WHEN film_id % 20 = 3 THEN rental_rate + 1 ELSE rental_rate END AS DECIMAL(12,2))",
            "rating": "CASE WHEN film_id % 20 = 13 THEN CONCAT(rating, '*') ELSE rating END"},
            stamped="film", deletable=False)

    def _inventory(self) -> DataFrame:
        base = self.inventory_base()
        if self.batch == 1:
            return self._batch(base, "inventory_id", "dim", {})
        last = self.film_base().groupBy().max("film_id").toDF("last").scalar()
        rows = self._batch(base.withColumn("last_film", last), "inventory_id", "dim", {
            "film_id": "CASE WHEN inventory_id % 20 = 3 AND film_id + 1 <= last_film THEN film_id + 1 ELSE film_id END",
            "store_id": "CASE WHEN inventory_id % 20 = 13 THEN (store_id + 1) % 25 ELSE store_id END"})
        return rows.drop("last_film")

    def _staff(self) -> DataFrame:
        return self._batch(self.raw("supplier").selectExpr(*_STAFF), "staff_id", "dim", {
            "first_name": "CASE WHEN staff_id % 20 = 3 THEN CONCAT(first_name, ' II') ELSE first_name END",
            "store_id": "CASE WHEN staff_id % 20 = 13 THEN (store_id + 1) % 25 ELSE store_id END"})

    def _rental(self) -> DataFrame:
        return self._batch(self.rental_base(), "(rental_id + 7)", "fact", {
            "inventory_id": "CASE WHEN (rental_id + 7) % 20 = 13 THEN 1L ELSE inventory_id END"},
            first={"return_date": "CASE WHEN (rental_id + 7) % 20 <> 3 THEN return_date END"})

    def _payment(self) -> DataFrame:
        return self._batch(self.payment_base(), "payment_id", "fact", {
            "staff_id": "CASE WHEN payment_id % 20 = 13 THEN 5L ELSE staff_id END",
            "amount": "CAST(CASE WHEN payment_id % 20 = 3 THEN amount + 1 ELSE amount END AS DECIMAL(12,2))"})

    def _small(self, df: DataFrame, key: str, column: str, change: str) -> DataFrame:
        return self._batch(df, key, "dim", {column: f"CASE WHEN {key} % 20 = 3 THEN {change} ELSE {column} END"},
                           classes="3, 19", touched=False, deletable=False)

    def _address(self) -> DataFrame:
        return self._small(self.raw("nation").selectExpr(*_ADDRESS), "address_id", "address", "CONCAT(address, ' *')")

    def _city(self) -> DataFrame:
        return self._small(self.raw("region").selectExpr(*_CITY), "city_id", "city", "CONCAT(city, ' *')")

    def _store(self) -> DataFrame:
        return self._small(self.raw("nation").selectExpr(*_STORE), "store_id", "manager_staff_id", "5L")

    def _customer(self) -> DataFrame:
        return self.raw("customer").selectExpr("c_custkey AS customer_id")
