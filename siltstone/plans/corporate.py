"""Normalised corporate warehouse: staging → ods → ref → integ → dds → mart."""

from __future__ import annotations

from pyspark.sql import DataFrame

from siltstone.operators.extract import extract_full, extract_incremental
from siltstone.operators.keys import Registry, new_keys, replace_keys
from siltstone.operators.scd import scd2_hash
from siltstone.operators.upsert import changes_since_target, upsert
from siltstone.plans.common import JOURNAL, Save, State, declared, each, extend, in_reach, in_steps, load_records, marks, refuse_reuse, small
from siltstone.plans.marts import corporate_sales_by_date, corporate_sales_by_film
from siltstone.schemas import CORPORATE
from siltstone.session import materialize
from siltstone.sources.remote import Source

ENTITIES = ["film", "inventory", "address", "city", "staff", "store", "payment", "rental"]
DIMENSIONS = ["film", "inventory", "address", "city", "staff", "store"]
FACTS = ["payment", "rental"]

# Which registry replaces which column. Language, country and customer keys stay natural.
REFERENCES = {
    "film": {"film_id": "film"},
    "inventory": {"inventory_id": "inventory", "film_id": "film", "store_id": "store"},
    "address": {"address_id": "address", "city_id": "city"},
    "city": {"city_id": "city"},
    "staff": {"staff_id": "staff", "address_id": "address", "store_id": "store"},
    "store": {"store_id": "store", "manager_staff_id": "staff", "address_id": "address"},
    "payment": {"payment_id": "payment", "staff_id": "staff", "rental_id": "rental"},
    "rental": {"rental_id": "rental", "inventory_id": "inventory", "staff_id": "staff"},
}


def registry(state: State, name: str) -> Registry:
    return Registry(state[f"ref.{name}"], f"{name}_sk", f"{name}_nk")


def registries(state: State, name: str) -> dict[str, Registry]:
    return {column: registry(state, entity) for column, entity in REFERENCES[name].items()}


def stage(source: Source, journal: DataFrame, load_ts: str, save: Save, only: list[str] | None = None) -> State:
    """Extract: changes of rentals, full copies of the rest."""
    names = only or ENTITIES
    since = marks(journal, ["staging.rental"])["staging.rental"]

    def extract(name: str) -> tuple[str, DataFrame]:
        rows, cols = declared(source, CORPORATE, f"staging.{name}")
        rows = extract_incremental(rows, cols, since) if name == "rental" else extract_full(rows, cols)
        return f"staging.{name}", save(rows, f"staging.{name}")

    staged = each(names, extract)
    staged[JOURNAL] = extend(save, journal, load_records(journal.sparkSession, [f"staging.{n}" for n in names], load_ts), JOURNAL)
    return staged


def load_ods(state: State, save: Save, only: list[str] | None = None) -> State:
    """Facts are upserted, so that a row gone from the source survives; the rest is replaced."""
    def load(name: str) -> tuple[str, DataFrame]:
        table, staged = f"ods.{name}", state[f"staging.{name}"]
        if name not in FACTS:
            return table, save(staged, table)
        # rentals come as changes, payments as a whole: most of what is stored comes again
        return table, save(upsert(in_reach(save, state[table], table, staged), staged, f"{name}_id", few=name == "rental"), table)

    return each(only or ENTITIES, load)


def load_registries(state: State, save: Save, only: list[str] | None = None) -> State:
    def load(name: str) -> tuple[str, DataFrame]:
        table = f"ref.{name}"
        added = new_keys(state[table], state[f"ods.{name}"].select(f"{name}_id"), f"{name}_sk", f"{name}_nk")
        rows = extend(save, state[table], added, table)
        return table, rows if name in FACTS else small(rows)

    return each(only or ENTITIES, load)


def integrate_fact(target: DataFrame, source: DataFrame, name: str, state: State, save: Save) -> DataFrame:
    """Upsert of the rows newer than the target, with surrogate keys.

    The keys to remove are translated to surrogates before they are compared with the
    target, which holds surrogates (comparing natural keys there would remove wrong rows).
    """
    delta = changes_since_target(target, source)
    gone = replace_keys(delta.select(f"{name}_id"), {f"{name}_id": registry(state, name)})
    reached = in_reach(save, target, f"integ.{name}", gone)
    return upsert(reached, replace_keys(delta, registries(state, name)), f"{name}_id", gone, few=True)


def integrate(state: State, save: Save, only: list[str] | None = None) -> State:
    def load(name: str) -> tuple[str, DataFrame]:
        table, rows = f"integ.{name}", state[f"ods.{name}"]
        rows = (integrate_fact(state[table], rows, name, state, save) if name in FACTS
                else replace_keys(rows, registries(state, name)))
        return table, save(rows, table)

    return each(only or ENTITIES, load)


def load_dds(state: State, load_ts: str, save: Save, only: list[str] | None = None) -> State:
    def load(name: str) -> tuple[str, DataFrame]:
        snapshot = state[f"integ.{name}"]
        if name in FACTS:
            table = f"dds.fact_{name}"
            delta = changes_since_target(state[table], snapshot)
            return table, save(upsert(in_reach(save, state[table], table, delta), delta, f"{name}_id", few=True), table)
        table = f"dds.dim_{name}"
        return table, save(scd2_hash(state[table], snapshot, f"{name}_id", load_ts), table)

    return each(only or ENTITIES, load)


def load_marts(state: State, save: Save) -> State:
    by_date = corporate_sales_by_date(state["dds.fact_payment"], state["mart.calendar"])
    by_film = corporate_sales_by_film(state["dds.fact_payment"], state["dds.fact_rental"], state["dds.dim_inventory"],
                                      state["dds.dim_film"])
    return {"mart.sales_by_date": save(by_date, "mart.sales_by_date"), "mart.sales_by_film": save(by_film, "mart.sales_by_film")}


def run_corporate(source: Source, state: State, load_ts: str, save: Save = materialize) -> State:
    """PIPE-I: one load with one load time. `state` needs a filled `mart.calendar`."""
    refuse_reuse(state[JOURNAL], load_ts)
    return in_steps(
        state, lambda s: stage(source, s[JOURNAL], load_ts, save), lambda s: load_ods(s, save), lambda s: load_registries(s, save),
        lambda s: integrate(s, save), lambda s: load_dds(s, load_ts, save), lambda s: load_marts(s, save))
