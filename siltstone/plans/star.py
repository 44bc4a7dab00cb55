"""Dimensional star: staging → core → mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.dates import timestamp
from siltstone.operators.extract import extract_full, extract_incremental, extract_incremental_enriched
from siltstone.operators.facts import load_fact_rental, merge_payments, signed_changes
from siltstone.operators.journal import previous_load_time
from siltstone.operators.keys import fill_keys
from siltstone.operators.scd import Lookup, scd2_merge, scd2_split
from siltstone.plans.common import JOURNAL, Save, State, declared, each, extend, in_reach, in_steps, lazily, load_records, marks, refuse_reuse
from siltstone.plans.marts import add_up, by_title, dated, summed
from siltstone.schemas import STAR, columns, reset
from siltstone.session import materialize
from siltstone.sources.remote import Source, align_columns

FILM_ATTRIBUTES = ["title", "rental_duration", "rental_rate", "length", "rating"]
_JOURNALED = ["staging.film", "staging.inventory", "staging.staff", "staging.rental", "staging.payment"]


def stage(source: Source, journal: DataFrame, load_ts: str, save: Save, only: list[str] | None = None) -> State:
    """Extract: changes of discs, staff, rentals and payments, full copies of the rest."""
    since = marks(journal, _JOURNALED)

    def extract(name: str) -> tuple[str, DataFrame]:
        table = f"staging.{name}"
        if name == "payment":
            fact = align_columns(source(name), {"last_update": "timestamp_ntz", "deleted": "timestamp_ntz"})
            rows = extract_incremental_enriched(fact, source("rental"), "rental_id", ["inventory_id"],
                                                list(columns(STAR, table)), since[table])
        else:
            rows, names = declared(source, STAR, table)
            rows = (extract_incremental(rows, names, since[table]) if name in ("inventory", "staff", "rental")
                    else extract_full(rows, names))
        return table, save(rows, table)

    staged = each(only or ["film", "inventory", "staff", "rental", "payment", "address", "city", "store"], extract)
    staged[JOURNAL] = extend(save, journal, load_records(journal.sparkSession, _JOURNALED, load_ts), JOURNAL)
    return staged


def describe_disc(film: DataFrame) -> Lookup:
    return lambda rows: rows.join(film.select("film_id", *FILM_ATTRIBUTES), "film_id")


def describe_staff(store: DataFrame, address: DataFrame, city: DataFrame) -> Lookup:
    """Staff have the address of their store."""
    places = store.select("store_id", "address_id").join(
        address.select("address_id", "address", "district", "city_id"), "address_id").join(
        city.select("city_id", F.col("city").alias("city_name")), "city_id").select(
        "store_id", "address", "district", "city_name")
    return lambda rows: rows.join(places, "store_id")


def load_dim_inventory(dim: DataFrame, staged: DataFrame, film: DataFrame, previous_film_load: str | None) -> DataFrame:
    """SCD-1 to SCD-4. There is nothing to split on the first load."""
    merged = scd2_merge(dim, staged, "inventory_id", describe_disc(film))
    if previous_film_load:
        changes = film.filter(F.col("last_update") >= timestamp(previous_film_load))
        merged = scd2_split(merged, changes, "film_id", FILM_ATTRIBUTES, pk="inventory_pk")
    return fill_keys(merged, "inventory_pk", dim)


def load_dim_staff(dim: DataFrame, staged: DataFrame, store: DataFrame, address: DataFrame, city: DataFrame) -> DataFrame:
    """SCD-1 to SCD-3. A changed address alone makes no version."""
    return fill_keys(scd2_merge(dim, staged, "staff_id", describe_staff(store, address, city)), "staff_pk", dim)


def load_dims(state: State, save: Save) -> State:
    def load(name: str) -> tuple[str, DataFrame]:
        dim, staged = state[f"core.dim_{name}"], state[f"staging.{name}"]
        if name == "inventory":
            previous = previous_load_time(state[JOURNAL], "staging.film")
            rows = load_dim_inventory(dim, staged, state["staging.film"], previous)
        else:
            rows = load_dim_staff(dim, staged, state["staging.store"], state["staging.address"], state["staging.city"])
        return f"core.dim_{name}", save(rows, f"core.dim_{name}")

    return each(["inventory", "staff"], load)


CHANGES = "changes.payment"


def load_facts(state: State, save: Save, only: list[str] | None = None, with_changes: bool = True) -> State:
    """Both facts; `CHANGES` holds what the load changed in the payments, for the marts, unless there are none."""
    watched = ["payment_date_fk", "inventory_fk", "amount"]

    def load(name: str) -> tuple[str, DataFrame]:
        table, staged = f"core.fact_{name}", state[f"staging.{name}"]
        fact, first = in_reach(save, state[table], table, staged), state[table].isEmpty()
        context = staged, state["core.dim_inventory"], state["core.dim_staff"], state["core.dim_date"]
        if name == "payment":
            past, merged = merge_payments(fact, *context)
            if with_changes and not first:  # as large as the change; the fact and the marts follow from it
                was = F.when(F.col("_was").isNotNull(), F.struct(*[F.col("_was")[c].alias(c) for c in watched]))
                merged = materialize(merged.withColumn("_was", was), "payments")
                changes[CHANGES] = signed_changes(merged, watched)
            rows = past.unionByName(merged.select(*fact.columns))
        else:
            rows = load_fact_rental(fact, *context, **{"save": lazily} if first else {})
        saved = save(fill_keys(rows, f"{name}_pk", state[table]), table)
        if name == "payment" and with_changes and first:  # all that is there now came with this load
            changes[CHANGES] = saved.select(*watched, F.lit(1).alias("sign"))
        return table, saved

    changes: State = {}
    return each(only or ["payment", "rental"], load) | changes


def load_marts(state: State, save: Save) -> State:
    """MRT-1 and MRT-2 kept up by what the load changed: the old version out, the new one in. The fact isn't read."""
    by_day = summed(state[CHANGES].withColumnRenamed("payment_date_fk", "date_pk"), "date_pk")
    by_film = by_title(summed(state[CHANGES], "inventory_fk"), state["core.dim_inventory"])
    deltas = {"mart.date_sums": ("date_pk", by_day), "mart.film_sums": ("film_title", by_film)}
    sums = each(deltas, lambda t: (t, save(add_up(state[t], deltas[t][1], deltas[t][0]), t)))
    shown = {"mart.sales_date": dated(sums["mart.date_sums"], state["core.dim_date"]),
             "mart.sales_film": sums["mart.film_sums"].select("film_title", "amount")}
    return sums | each(shown, lambda t: (t, save(shown[t], t)))


def rebuild_marts(state: State, save: Save) -> State:
    """The same from the whole fact, for a state whose sums are missing or in doubt."""
    whole = state["core.fact_payment"].select("payment_date_fk", "inventory_fk", "amount", F.lit(1).alias("sign"))
    return load_marts(reset(whole.sparkSession, STAR, tables=["mart.date_sums", "mart.film_sums"]) | {
        CHANGES: whole, **{t: state[t] for t in ("core.dim_inventory", "core.dim_date")}}, save)


def run_star(source: Source, state: State, load_ts: str, save: Save = materialize) -> State:
    """PIPE-K: one load with one load time. `state` needs a filled `core.dim_date`."""
    refuse_reuse(state[JOURNAL], load_ts)
    state = in_steps(state, lambda s: stage(source, s[JOURNAL], load_ts, save), lambda s: load_dims(s, save),
                     lambda s: load_facts(s, save), lambda s: load_marts(s, save))
    return {name: df for name, df in state.items() if name != CHANGES}
