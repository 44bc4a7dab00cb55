"""Declared tables of the three warehouses, by layer.

Keys are BIGINT and amounts wider than a film-rental shop needs. `NOT NULL` and the
text lengths are declarations for the checks (Parquet does not enforce them).
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_JOURNAL = "table_name STRING NOT NULL, update_dt TIMESTAMP_NTZ NOT NULL"
_FILM_PAYLOAD = ("title STRING NOT NULL, description STRING, release_year INT, language_id BIGINT, "
                 "rental_duration INT NOT NULL, rental_rate DECIMAL(12,2) NOT NULL, length INT, "
                 "replacement_cost DECIMAL(12,2) NOT NULL, rating STRING")
_FILM_EXTRA = "special_features ARRAY<STRING>, fulltext STRING"
_FILM = f"film_id BIGINT NOT NULL, {_FILM_PAYLOAD}, last_update TIMESTAMP_NTZ NOT NULL, {_FILM_EXTRA}"
_CHANGED = "last_update TIMESTAMP_NTZ NOT NULL, deleted TIMESTAMP_NTZ"
_INVENTORY = f"inventory_id BIGINT NOT NULL, film_id BIGINT NOT NULL, store_id BIGINT NOT NULL, {_CHANGED}"
_ADDRESS_PAYLOAD = ("address STRING NOT NULL, district STRING NOT NULL, city_id BIGINT NOT NULL, postal_code STRING, "
                    "phone STRING")
_CITY_PAYLOAD = "city STRING NOT NULL, country_id BIGINT"
_STAFF_PAYLOAD = ("first_name STRING NOT NULL, last_name STRING NOT NULL, address_id BIGINT NOT NULL, email STRING, "
                  "store_id BIGINT NOT NULL, username STRING")
_STORE_PAYLOAD = "manager_staff_id BIGINT NOT NULL, address_id BIGINT NOT NULL"
_PAYMENT = ("payment_id BIGINT NOT NULL, customer_id BIGINT NOT NULL, staff_id BIGINT NOT NULL, "
            "rental_id BIGINT NOT NULL, amount DECIMAL(12,2) NOT NULL, payment_date TIMESTAMP_NTZ NOT NULL, "
            "deleted TIMESTAMP_NTZ, last_update TIMESTAMP_NTZ NOT NULL")
_RENTAL = ("rental_id BIGINT NOT NULL, rental_date TIMESTAMP_NTZ NOT NULL, inventory_id BIGINT NOT NULL, "
           f"customer_id BIGINT NOT NULL, return_date TIMESTAMP_NTZ, staff_id BIGINT NOT NULL, {_CHANGED}")


def _span(prefix: str) -> str:
    start, end = ("effective_date_from", "effective_date_to") if prefix == "star" else (
        "date_effective_from", "date_effective_to")
    return f"{start} TIMESTAMP_NTZ NOT NULL, {end} TIMESTAMP_NTZ NOT NULL, is_active BOOLEAN NOT NULL"


STAR = {
    "staging.last_update_data": _JOURNAL,
    "staging.film": _FILM,
    "staging.inventory": _INVENTORY,
    "staging.staff": "staff_id BIGINT NOT NULL, first_name STRING NOT NULL, last_name STRING NOT NULL, "
                     f"store_id BIGINT NOT NULL, {_CHANGED}",
    "staging.rental": _RENTAL,
    "staging.payment": "payment_id BIGINT NOT NULL, customer_id BIGINT NOT NULL, staff_id BIGINT NOT NULL, "
                       "rental_id BIGINT NOT NULL, inventory_id BIGINT NOT NULL, amount DECIMAL(12,2) NOT NULL, "
                       f"payment_date TIMESTAMP_NTZ NOT NULL, {_CHANGED}",
    "staging.address": "address_id BIGINT NOT NULL, address STRING NOT NULL, district STRING NOT NULL, city_id BIGINT NOT NULL",
    "staging.city": "city_id BIGINT NOT NULL, city STRING NOT NULL",
    "staging.store": "store_id BIGINT NOT NULL, address_id BIGINT NOT NULL",
    "core.dim_inventory": "inventory_pk BIGINT NOT NULL, inventory_id BIGINT NOT NULL, film_id BIGINT NOT NULL, "
                          "title STRING NOT NULL, rental_duration INT NOT NULL, rental_rate DECIMAL(12,2) NOT NULL, "
                          f"length INT, rating STRING, {_span('star')}",
    "core.dim_staff": "staff_pk BIGINT NOT NULL, staff_id BIGINT NOT NULL, first_name STRING NOT NULL, "
                      "last_name STRING NOT NULL, address STRING NOT NULL, district STRING NOT NULL, "
                      f"city_name STRING NOT NULL, {_span('star')}",
    "core.dim_date": "date_pk INT NOT NULL, date_actual DATE NOT NULL, day_name STRING NOT NULL, day_of_week INT NOT NULL, "
                     "day_of_month INT NOT NULL, day_of_quarter INT NOT NULL, day_of_year INT NOT NULL, "
                     "week_of_month INT NOT NULL, week_of_year INT NOT NULL, month_actual INT NOT NULL, "
                     "month_name STRING NOT NULL, month_name_abbreviated STRING NOT NULL, quarter_actual INT NOT NULL, "
                     "year_actual INT NOT NULL, first_day_of_week DATE NOT NULL, last_day_of_week DATE NOT NULL, "
                     "first_day_of_month DATE NOT NULL, last_day_of_month DATE NOT NULL, "
                     "first_day_of_quarter DATE NOT NULL, last_day_of_quarter DATE NOT NULL, "
                     "first_day_of_year DATE NOT NULL, last_day_of_year DATE NOT NULL, mmyyyy STRING NOT NULL, "
                     "mmddyyyy STRING NOT NULL, weekend_indr BOOLEAN NOT NULL",
    "core.fact_payment": "payment_pk BIGINT NOT NULL, payment_id BIGINT NOT NULL, rental_id BIGINT NOT NULL, "
                         "amount DECIMAL(12,2) NOT NULL, payment_date_fk INT NOT NULL, inventory_fk BIGINT NOT NULL, "
                         f"staff_fk BIGINT NOT NULL, {_span('star')}",
    "core.fact_rental": "rental_pk BIGINT NOT NULL, rental_id BIGINT NOT NULL, rental_date_fk INT NOT NULL, "
                        f"return_date_fk INT, inventory_fk BIGINT NOT NULL, staff_fk BIGINT NOT NULL, {_span('star')}",
    # what the two marts are kept up from: sums with their number of payment versions
    "mart.date_sums": "date_pk INT NOT NULL, n BIGINT NOT NULL, amount DECIMAL(18,2) NOT NULL",
    "mart.film_sums": "film_title STRING, n BIGINT NOT NULL, amount DECIMAL(18,2) NOT NULL",
    "mart.sales_date": "date_title STRING NOT NULL, date_sort INT NOT NULL, amount DECIMAL(18,2) NOT NULL",
    "mart.sales_film": "film_title STRING NOT NULL, amount DECIMAL(18,2) NOT NULL",
}

_ENTITIES = {
    "film": _FILM,
    "inventory": _INVENTORY,
    "address": f"address_id BIGINT NOT NULL, {_ADDRESS_PAYLOAD}, last_update TIMESTAMP_NTZ NOT NULL",
    "city": f"city_id BIGINT NOT NULL, {_CITY_PAYLOAD}, last_update TIMESTAMP_NTZ NOT NULL",
    "staff": f"staff_id BIGINT NOT NULL, {_STAFF_PAYLOAD}, {_CHANGED}",
    "store": f"store_id BIGINT NOT NULL, {_STORE_PAYLOAD}, last_update TIMESTAMP_NTZ NOT NULL",
    "payment": _PAYMENT,
    "rental": _RENTAL,
}

CORPORATE = {
    "staging.last_update_data": _JOURNAL,
    **{f"{layer}.{name}": ddl for layer in ("staging", "ods", "integ") for name, ddl in _ENTITIES.items()},
    **{f"ref.{name}": f"{name}_sk BIGINT NOT NULL, {name}_nk BIGINT NOT NULL" for name in _ENTITIES},
    "dds.dim_film": f"film_id BIGINT NOT NULL, {_FILM_PAYLOAD}, {_FILM_EXTRA}, {_span('corp')}, hash STRING NOT NULL",
    "dds.dim_inventory": "inventory_id BIGINT NOT NULL, film_id BIGINT NOT NULL, store_id BIGINT NOT NULL, "
                         f"{_span('corp')}, hash STRING NOT NULL",
    "dds.dim_address": f"address_id BIGINT NOT NULL, {_ADDRESS_PAYLOAD}, {_span('corp')}, hash STRING NOT NULL",
    "dds.dim_city": f"city_id BIGINT NOT NULL, {_CITY_PAYLOAD}, {_span('corp')}, hash STRING NOT NULL",
    "dds.dim_staff": f"staff_id BIGINT NOT NULL, {_STAFF_PAYLOAD}, {_span('corp')}, hash STRING NOT NULL",
    "dds.dim_store": f"store_id BIGINT NOT NULL, {_STORE_PAYLOAD}, {_span('corp')}, hash STRING NOT NULL",
    "dds.fact_payment": _PAYMENT,
    "dds.fact_rental": _RENTAL,
    "mart.calendar": "date_id INT NOT NULL, date_actual DATE NOT NULL, day_of_month INT NOT NULL, "
                     "month_name STRING NOT NULL, year INT NOT NULL",
    "mart.sales_by_date": "sales_date_id INT NOT NULL, sales_date_title STRING NOT NULL, amount DOUBLE NOT NULL",
    "mart.sales_by_film": "film_title STRING NOT NULL, amount DECIMAL(18,2) NOT NULL",
}

_STAMP = "load_date TIMESTAMP_NTZ NOT NULL, record_source STRING NOT NULL"
_SAT = "load_date TIMESTAMP_NTZ NOT NULL, load_end_date TIMESTAMP_NTZ, record_source STRING NOT NULL"

VAULT = {
    "staging.last_update_data": _JOURNAL,
    "staging.film": f"{_FILM}, hub_film_hash_key STRING NOT NULL, film_static_hash_diff STRING NOT NULL, "
                    f"film_dynamic_hash_diff STRING NOT NULL, {_STAMP}",
    "staging.inventory": f"{_INVENTORY}, hub_inventory_hash_key STRING NOT NULL, hub_film_hash_key STRING NOT NULL, "
                         f"link_film_inventory_hash_key STRING NOT NULL, {_STAMP}",
    "staging.rental": f"{_RENTAL}, hub_rental_hash_key STRING NOT NULL, hub_inventory_hash_key STRING NOT NULL, "
                      f"link_rental_inventory_hash_key STRING NOT NULL, {_STAMP}",
    "edw.hub_film": f"hub_film_hash_key STRING NOT NULL, {_STAMP}, film_id BIGINT NOT NULL",
    "edw.hub_inventory": f"hub_inventory_hash_key STRING NOT NULL, {_STAMP}, inventory_id BIGINT NOT NULL",
    "edw.hub_rental": f"hub_rental_hash_key STRING NOT NULL, {_STAMP}, rental_id BIGINT NOT NULL",
    "edw.link_film_inventory": f"link_film_inventory_hash_key STRING NOT NULL, {_STAMP}, hub_film_hash_key STRING, "
                               "hub_inventory_hash_key STRING",
    "edw.link_rental_inventory": f"link_rental_inventory_hash_key STRING NOT NULL, {_STAMP}, hub_rental_hash_key STRING, "
                                 "hub_inventory_hash_key STRING",
    "edw.sat_film_static": f"hub_film_hash_key STRING NOT NULL, {_SAT}, hash_diff STRING NOT NULL, title STRING, "
                           "description STRING, release_year INT, length INT, rating STRING",
    "edw.sat_film_dynamic": f"hub_film_hash_key STRING NOT NULL, {_SAT}, hash_diff STRING NOT NULL, rental_duration INT, "
                            "rental_rate DECIMAL(12,2), replacement_cost DECIMAL(12,2)",
    "edw.sat_film_inventory": f"link_film_inventory_hash_key STRING NOT NULL, {_SAT}",
    "edw.sat_inventory": f"hub_inventory_hash_key STRING NOT NULL, {_SAT}",
    "edw.sat_rental_inventory": f"link_rental_inventory_hash_key STRING NOT NULL, {_SAT}",
    "edw.sat_rental_static": f"hub_rental_hash_key STRING NOT NULL, {_SAT}, rental_date TIMESTAMP_NTZ",
    "edw.sat_rental_dynamic": f"hub_rental_hash_key STRING NOT NULL, {_SAT}, return_date TIMESTAMP_NTZ",
    "mart.rented_film": "film_title STRING NOT NULL, quantity BIGINT NOT NULL",
}

# Declared text lengths, ratings and the range of release years.
LENGTHS = {"title": 255, "rating": 10, "first_name": 45, "last_name": 45, "address": 50, "district": 20, "city": 50,
           "city_name": 50, "postal_code": 10, "phone": 20, "email": 50, "username": 16, "table_name": 100,
           "record_source": 50, "film_title": 100}
RATINGS = ["G", "PG", "PG-13", "R", "NC-17"]
YEARS = (1901, 2155)


@lru_cache(maxsize=None)
def _parsed(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def columns(tables: dict[str, str], name: str) -> dict[str, str]:
    """Declared columns of a table: name → type."""
    return {f.name: f.dataType.simpleString() for f in _parsed(tables[name])}


def empty(spark: SparkSession, tables: dict[str, str], name: str) -> DataFrame:
    """Known to the optimizer as empty, so that a first load plans no join with it."""
    return spark.sql("SELECT " + ", ".join(f"CAST(NULL AS {t}) AS {c}" for c, t in columns(tables, name).items())
                     + " WHERE FALSE")


def reset(spark: SparkSession, declared: dict[str, str], layers: list[str] | None = None,
          tables: list[str] | None = None) -> dict[str, DataFrame]:
    """PIPE-0: empty typed tables of all or some layers. A calendar has to be filled again afterwards."""
    wanted = tables if tables is not None else [n for n in declared if layers is None or n.split(".")[0] in layers]
    return {n: empty(spark, declared, n) for n in wanted}


def not_null(tables: dict[str, str], name: str) -> list[str]:
    return [f.name for f in _parsed(tables[name]) if not f.nullable]
