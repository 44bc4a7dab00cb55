"""Data vault: staging → edw → mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.dates import timestamp
from siltstone.functions.hashing import hash_diff, hash_key, link_key
from siltstone.operators.extract import extract_full, extract_incremental
from siltstone.operators.vault import (ending_rows, hub_additions, link_additions, load_plain_satellite, load_satellite,
                                       with_computed_diff)
from siltstone.plans.common import JOURNAL, Save, State, declared, each, extend, in_reach, in_steps, load_records, marks, refuse_reuse
from siltstone.plans.marts import rented_film
from siltstone.schemas import _FILM, _INVENTORY, _RENTAL
from siltstone.session import materialize
from siltstone.sources.remote import Source

STATIC = ["title", "description", "release_year", "length", "rating"]
DYNAMIC = ["rental_duration", "rental_rate", "replacement_cost"]

_SOURCES = {"staging.film": _FILM, "staging.inventory": _INVENTORY, "staging.rental": _RENTAL}


def hashes(name: str) -> dict:
    """Hash columns of a staged table."""
    if name == "film":
        return {"hub_film_hash_key": hash_key("film_id"), "film_static_hash_diff": hash_diff(*STATIC),
                "film_dynamic_hash_diff": hash_diff(*DYNAMIC)}
    if name == "inventory":
        return {"hub_inventory_hash_key": hash_key("inventory_id"), "hub_film_hash_key": hash_key("film_id"),
                "link_film_inventory_hash_key": link_key("film_id", "inventory_id")}
    return {"hub_rental_hash_key": hash_key("rental_id"), "hub_inventory_hash_key": hash_key("inventory_id"),
            "link_rental_inventory_hash_key": link_key("rental_id", "inventory_id")}


def stage(source: Source, journal: DataFrame, load_ts: str, save: Save, only: list[str] | None = None,
          record_source: str = "film_rental_db") -> State:
    """Extract and hash: changes of rentals, full copies of films and discs."""
    names = only or ["film", "inventory", "rental"]
    since = marks(journal, ["staging.rental"])["staging.rental"]

    def extract(name: str) -> tuple[str, DataFrame]:
        table = f"staging.{name}"
        rows, cols = declared(source, _SOURCES, table)
        rows = extract_incremental(rows, cols, since) if name == "rental" else extract_full(rows, cols)
        return table, save(rows.withColumns(hashes(name) | {
            "load_date": timestamp(load_ts), "record_source": F.lit(record_source)}), table)

    staged = each(names, extract)
    staged[JOURNAL] = extend(save, journal, load_records(journal.sparkSession, [f"staging.{n}" for n in names], load_ts), JOURNAL)
    return staged


HUB_FEEDS = {"film": ["film", "inventory"], "inventory": ["inventory", "rental"], "rental": ["rental"]}
LINK_ENDS = {"film_inventory": ("inventory", "film"), "rental_inventory": ("rental", "rental")}


def load_hubs(state: State, save: Save, only: list[str] | None = None) -> State:
    def load(name: str) -> tuple[str, DataFrame]:
        table, feeds = f"edw.hub_{name}", [state[f"staging.{s}"] for s in HUB_FEEDS[name]]
        return table, extend(save, state[table], hub_additions(state[table], feeds, f"hub_{name}_hash_key", f"{name}_id"), table)

    return each(only or HUB_FEEDS, load)


def load_links(state: State, save: Save, only: list[str] | None = None) -> State:
    def load(name: str) -> tuple[str, DataFrame]:
        table, (staged, parent) = f"edw.link_{name}", LINK_ENDS[name]
        added = link_additions(state[table], state[f"staging.{staged}"], f"link_{name}_hash_key",
                               [f"hub_{parent}_hash_key", "hub_inventory_hash_key"])
        return table, extend(save, state[table], added, table)

    return each(only or LINK_ENDS, load)


# satellite → staged table, key, stored diff (None: computed), payload, whether the staged rows are a snapshot
SATELLITES = {
    "film_static": ("film", "hub_film_hash_key", "film_static_hash_diff", STATIC, True),
    "film_dynamic": ("film", "hub_film_hash_key", "film_dynamic_hash_diff", DYNAMIC, True),
    "film_inventory": ("inventory", "link_film_inventory_hash_key", None, [], True),
    "inventory": ("inventory", "hub_inventory_hash_key", None, [], True),
    "rental_inventory": ("rental", "link_rental_inventory_hash_key", None, [], False),
    "rental_static": ("rental", "hub_rental_hash_key", None, ["rental_date"], False),
    "rental_dynamic": ("rental", "hub_rental_hash_key", None, ["return_date"], False),
}


def load_satellites(state: State, load_ts: str, save: Save, only: list[str] | None = None) -> State:
    def load(name: str) -> tuple[str, DataFrame]:
        staged, key, diff, payload, full = SATELLITES[name]
        table, rows = f"edw.sat_{name}", state[f"staging.{staged}"]
        known = state[table]
        if diff:
            part = in_reach(save, known, table, ending_rows(known, rows, key, diff, load_ts, full))
            return table, save(load_satellite(part, rows, key, diff, payload, load_ts, full, known), table)
        computed, incoming = with_computed_diff(known, rows, payload)
        part = in_reach(save, known, table, ending_rows(computed, incoming, key, "_staged_diff", load_ts, full))
        return table, save(load_plain_satellite(part, rows, key, payload, load_ts, full, known), table)

    return each(only or SATELLITES, load)


def load_marts(state: State, save: Save) -> State:
    return {"mart.rented_film": save(rented_film(
        state["edw.hub_film"], state["edw.sat_film_static"], state["edw.link_film_inventory"], state["edw.hub_inventory"],
        state["edw.link_rental_inventory"], state["edw.hub_rental"]), "mart.rented_film")}


def run_vault(source: Source, state: State, load_ts: str, save: Save = materialize) -> State:
    """PIPE-D: one load with one load time."""
    refuse_reuse(state[JOURNAL], load_ts)
    return in_steps(
        state, lambda s: stage(source, s[JOURNAL], load_ts, save), lambda s: load_hubs(s, save), lambda s: load_links(s, save),
        lambda s: load_satellites(s, load_ts, save), lambda s: load_marts(s, save))
