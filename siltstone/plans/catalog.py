"""The registered queries: each operator and pipeline on the two-batch rental source.

Every query takes (spark, folder) and reads whole tables of that folder. "Before"
is the state after the first batch, "after" the state after the second.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone import operators as op
from siltstone.functions.dates import date_key, timestamp
from siltstone.functions.hashing import hash_diff, hash_key, link_key, row_hash
from siltstone.plans import corporate, marts, star, vault
from siltstone.plans.checks import check_state
from siltstone.plans.common import JOURNAL, Save, State, lazily
from siltstone.schemas import CORPORATE, RATINGS, STAR, VAULT, YEARS, columns, reset
from siltstone.session import materialize, tune
from siltstone.sources.remote import align_columns
from siltstone.sources.retail import FIRST_LOAD, SECOND_LOAD, RetailSource

Query = Callable[[SparkSession, str], DataFrame]

CORPORATE_COLUMNS = {
    "film": ["film_id", "title", "description", "release_year", "rental_duration", "rental_rate", "length",
             "replacement_cost", "rating", "last_update"],
    "inventory": ["inventory_id", "film_id", "store_id", "last_update", "deleted"],
    "address": ["address_id", "address", "district", "city_id", "last_update"],
    "city": ["city_id", "city", "last_update"],
    "staff": ["staff_id", "first_name", "last_name", "address_id", "store_id", "last_update", "deleted"],
    "store": ["store_id", "manager_staff_id", "address_id", "last_update"],
    "payment": ["payment_id", "customer_id", "staff_id", "rental_id", "amount", "payment_date", "deleted", "last_update"],
    "rental": ["rental_id", "rental_date", "inventory_id", "customer_id", "return_date", "staff_id", "last_update", "deleted"],
}


def both(spark: SparkSession, folder: str, *stored: str) -> tuple[RetailSource, RetailSource]:
    first = RetailSource(spark, folder, 1).with_stored_facts(*stored)
    return first, first.other_batch()


# ---------------------------------------------------------------- extraction and upserts

def _journal(spark: SparkSession, folder: str) -> DataFrame:
    """The event log read as a load journal: event type for table, event time for load time."""
    return RetailSource(spark, folder).raw("events").select(F.col("event_type").alias("table_name"), F.col("ts").alias("update_dt"))


def extract_full_film(spark, folder):
    return op.extract_full(RetailSource(spark, folder)("film"), CORPORATE_COLUMNS["film"])


def high_water_mark(spark, folder):
    return op.high_water_marks(_journal(spark, folder), ["view", "click", "error", "purchase", "signup", "never_loaded"])


def record_load(spark, folder):
    return op.record_load(_journal(spark, folder), "staging.film", SECOND_LOAD)


def previous_load_time(spark, folder):
    return op.previous_load_times(_journal(spark, folder))


def extract_incremental(name, spark, folder):
    return op.extract_incremental(RetailSource(spark, folder)(name), list(columns(STAR, f"staging.{name}")), FIRST_LOAD)


def extract_incremental_payment(spark, folder):
    source = RetailSource(spark, folder)
    return op.extract_incremental_enriched(source("payment"), source("rental"), "rental_id", ["inventory_id"],
                                           list(columns(STAR, "staging.payment")), FIRST_LOAD)


def schema_evolution_align(spark, folder):
    return align_columns(RetailSource(spark, folder).payment_base(), {"deleted": "timestamp_ntz", "last_update": "timestamp_ntz"})


def upsert(name, spark, folder):
    first, second = both(spark, folder)
    return op.upsert(first(name), second(name), f"{name}_id").select(*CORPORATE_COLUMNS[name])


def upsert_since(name, spark, folder):
    first, second = both(spark, folder)
    target, mark = op.stored_with_mark(first(name), name)
    delta = materialize(op.changes_since_target(target, second(name), mark=mark), f"{name}-changes")
    return op.upsert(target, delta, f"{name}_id").select(*CORPORATE_COLUMNS[name])


# ---------------------------------------------------------------- corporate states

def _closure(names: list[str]) -> list[str]:
    """The entities whose registries the given ones need."""
    needed = list(names)
    for n in names:
        needed += [e for e in corporate.REFERENCES[n].values() if e not in needed]
    return needed


def corporate_state(spark: SparkSession, folder: str, names: list[str], upto: str, save: Save = materialize) -> State:
    """State after both batches, loaded as far as `upto` and only for the named entities."""
    needed = _closure(names)
    facts_only = lambda df, table: save(df, table) if table.endswith(("payment", "rental")) else df
    state = reset(spark, CORPORATE, tables=[JOURNAL, *[f"{layer}.{n}" for n in needed for layer in ("ods", "ref")],
                                            *[t for n in names for t in (f"integ.{n}", f"dds.dim_{n}", f"dds.fact_{n}")
                                              if t in CORPORATE]])
    for source, load_ts in zip(both(spark, folder, *[n for n in needed if n in corporate.FACTS]), (FIRST_LOAD, SECOND_LOAD),
                               strict=True):
        state = state | corporate.stage(source, state[JOURNAL], load_ts, lazily, needed)
        state = state | corporate.load_ods(state, facts_only, needed)
        # the new keys of a registry are written by its numbering, so nothing is written twice
        state = state | corporate.load_registries(state, lazily, needed)
        if upto in ("integ", "dds"):
            state = state | corporate.integrate(state, save, names)
        if upto == "dds":
            state = state | corporate.load_dds(state, load_ts, save, names)
    return state


def sync_keys(name, spark, folder):
    first, second = both(spark, folder)
    empty = reset(spark, CORPORATE, tables=[f"ref.{name}"])[f"ref.{name}"]
    key, sk, nk = f"{name}_id", f"{name}_sk", f"{name}_nk"
    # natural keys of the operational store; rentals and payments gone from the source stay in it
    before = op.sync_keys(empty, first(name).select(key), sk, nk)
    return op.sync_keys(before, second(name).select(key), sk, nk)


def replace_keys(name, spark, folder):
    state = corporate_state(spark, folder, [name], "ref")
    return op.replace_keys(state[f"ods.{name}"], corporate.registries(state, name)).select(*CORPORATE_COLUMNS[name])


def integrated(name, spark, folder):
    return corporate_state(spark, folder, [name], "integ")[f"integ.{name}"]


def corporate_fact(name, spark, folder):
    return corporate_state(spark, folder, [name], "dds")[f"dds.fact_{name}"]


def scd2_hash_dim(name, spark, folder):
    dim = corporate_state(spark, folder, [name], "dds")[f"dds.dim_{name}"]
    shown = [c for c in CORPORATE_COLUMNS[name] if c not in ("last_update", "deleted")]
    return dim.select(*shown, "date_effective_from", "date_effective_to", "is_active")


def _short_calendar(spark, folder):
    return op.describe_days_short(_data_days(spark, folder))


def sales_by_date_corp(spark, folder):
    fact = corporate_fact("payment", spark, folder)
    return marts.corporate_sales_by_date(fact, _short_calendar(spark, folder))


def sales_by_film_corp(spark, folder):
    state = corporate_state(spark, folder, ["payment", "rental", "inventory", "film"], "dds")
    return marts.corporate_sales_by_film(state["dds.fact_payment"], state["dds.fact_rental"], state["dds.dim_inventory"],
                                         state["dds.dim_film"])


def _read_by_function(spark, mart, columns):
    name = f"read_{uuid.uuid4().hex}"
    marts.register_reader(spark, mart, name, columns)
    return spark.sql(f"SELECT * FROM {name}()")


def mart_reader_by_date(spark, folder):
    return _read_by_function(spark, sales_by_date_corp(spark, folder), "sales_date_id INT, sales_date_title STRING, amount DOUBLE")


def mart_reader_by_film(spark, folder):
    return _read_by_function(spark, sales_by_film_corp(spark, folder), "film_title STRING, amount DOUBLE")


# ---------------------------------------------------------------- hashes

def hash_key_film(spark, folder):
    return RetailSource(spark, folder)("film").select("film_id", hash_key("film_id").alias("hub_film_hash_key"))


def hash_diff_film_static(spark, folder):
    return RetailSource(spark, folder)("film").select("film_id", hash_diff(*vault.STATIC).alias("film_static_hash_diff"))


def hash_diff_film_dynamic(spark, folder):
    return RetailSource(spark, folder)("film").select("film_id", hash_diff(*vault.DYNAMIC).alias("film_dynamic_hash_diff"))


def link_key_inventory(spark, folder):
    return RetailSource(spark, folder)("inventory").select(
        "inventory_id", "film_id", link_key("film_id", "inventory_id").alias("link_film_inventory_hash_key"))


def link_key_rental(spark, folder):
    return RetailSource(spark, folder)("rental").select(
        "rental_id", "inventory_id", link_key("rental_id", "inventory_id").alias("link_rental_inventory_hash_key"))


def row_hash_changed_film(spark, folder):
    first, second = (s("film").select(*CORPORATE_COLUMNS["film"]) for s in both(spark, folder))
    hashed = [df.select("film_id", row_hash(df.columns).alias(n)) for df, n in ((first, "before"), (second, "after"))]
    return hashed[0].join(hashed[1], "film_id").filter("before <> after").select("film_id")


# ---------------------------------------------------------------- star

def _dims_before(spark, folder, save: Save = lazily) -> tuple[State, State]:
    """Dimensions after the first load, and the staged second load."""
    first, second = both(spark, folder)
    state = reset(spark, STAR, tables=[JOURNAL, "core.dim_inventory", "core.dim_staff"])
    names = ["film", "inventory", "staff", "address", "city", "store"]
    state = state | star.stage(first, state[JOURNAL], FIRST_LOAD, lazily, names)
    state = state | star.load_dims(state, save)
    return state, star.stage(second, state[JOURNAL], SECOND_LOAD, lazily, names)


def _shown(dim: DataFrame) -> DataFrame:
    return dim.select(*[c for c in dim.columns if not c.endswith("_pk")])


def scd2_soft_delete_inventory(spark, folder):
    before, staged = _dims_before(spark, folder)
    return op.scd2_soft_delete(_shown(before["core.dim_inventory"]), staged["staging.inventory"], "inventory_id")


def scd2_new_inventory(spark, folder):
    before, staged = _dims_before(spark, folder)
    rows = op.scd2_soft_delete(_shown(before["core.dim_inventory"]), staged["staging.inventory"], "inventory_id")
    return op.scd2_insert_new(rows, staged["staging.inventory"], "inventory_id", star.describe_disc(staged["staging.film"]))


def scd2_version_inventory(spark, folder):
    before, staged = _dims_before(spark, folder)
    dim, lookup = _shown(before["core.dim_inventory"]), star.describe_disc(staged["staging.film"])
    rows = op.scd2_insert_new(op.scd2_soft_delete(dim, staged["staging.inventory"], "inventory_id"), staged["staging.inventory"], "inventory_id", lookup)
    return op.scd2_version(rows, staged["staging.inventory"], "inventory_id", lookup, seen=dim.select("inventory_id").distinct())


def scd2_merge_inventory(spark, folder):
    before, staged = _dims_before(spark, folder)
    return op.scd2_merge(_shown(before["core.dim_inventory"]), staged["staging.inventory"], "inventory_id",
                         star.describe_disc(staged["staging.film"]))


def scd2_dim_staff(spark, folder):
    before, staged = _dims_before(spark, folder)
    lookup = star.describe_staff(staged["staging.store"], staged["staging.address"], staged["staging.city"])
    return op.scd2_merge(_shown(before["core.dim_staff"]), staged["staging.staff"], "staff_id", lookup)


def scd2_dim_inventory(spark, folder):
    changes = RetailSource(spark, folder)("film").filter(F.col("last_update") >= timestamp(FIRST_LOAD))
    return op.scd2_split(scd2_merge_inventory(spark, folder), changes, "film_id", star.FILM_ATTRIBUTES)


def scd2_split_film_change(spark, folder):
    before, _ = _dims_before(spark, folder)
    changes = RetailSource(spark, folder)("film").filter(F.col("last_update") >= timestamp(FIRST_LOAD))
    return op.scd2_split(_shown(before["core.dim_inventory"]), changes, "film_id", star.FILM_ATTRIBUTES)


def _paid_rentals(spark, folder):
    source = RetailSource(spark, folder)
    return source("payment").join(source("rental").select("rental_id", "inventory_id"), "rental_id").select(
        "payment_id", "inventory_id", "last_update")


def as_of_join_payment_inventory(spark, folder):
    dim = materialize(scd2_dim_inventory(spark, folder), "discs")
    return op.as_of_join(_paid_rentals(spark, folder), dim, "inventory_id", "last_update",
                         {"title": "title", "rental_rate": "rental_rate", "effective_date_from": "inventory_from"})


def as_of_join_boundary(spark, folder):
    dim = materialize(scd2_dim_inventory(spark, folder), "discs")
    facts, counts = _paid_rentals(spark, folder), None
    for closed in ("both", "left"):
        hits = op.as_of_join(facts, dim, "inventory_id", "last_update", {"effective_date_from": "version"}, closed).select("payment_id", F.lit(closed).alias("closed"))
        counts = hits if counts is None else counts.unionByName(hits)
    return counts.groupBy("payment_id").agg(
        F.count(F.when(F.col("closed") == "both", 1)).alias("matches_both"),
        F.count(F.when(F.col("closed") == "left", 1)).alias("matches_left")).filter("matches_both <> matches_left")


def star_state(spark: SparkSession, folder: str, fact: str, save: Save = materialize) -> State:
    """Dimensions and one fact table after both batches."""
    state = reset(spark, STAR, tables=[JOURNAL, "core.dim_inventory", "core.dim_staff", f"core.fact_{fact}"])
    state["core.dim_date"] = op.describe_days(_data_days(spark, folder))
    names = ["film", "inventory", "staff", "address", "city", "store", fact]
    stored = ["payment", "rental"] if fact == "payment" else ["rental"]
    for source, load_ts in zip(both(spark, folder, *stored), (FIRST_LOAD, SECOND_LOAD), strict=True):
        again = not state[f"core.fact_{fact}"].isEmpty()  # a first load reads its staged facts once
        keep = lambda df, name: save(df, name) if again and name == f"staging.{fact}" else df
        state = state | star.stage(source, state[JOURNAL], load_ts, keep, names)
        state = state | star.load_dims(state, save)
        state = state | star.load_facts(state, save, [fact], with_changes=False)
    return state


def _with_natural_keys(state: State, fact: DataFrame, shown: list[str]) -> DataFrame:
    """Row keys shown as natural key and version start, which do not depend on numbering."""
    discs = state["core.dim_inventory"].select(F.col("inventory_pk").alias("inventory_fk"), "inventory_id",
                                               F.col("effective_date_from").alias("inventory_from"))
    people = state["core.dim_staff"].select(F.col("staff_pk").alias("staff_fk"), "staff_id",
                                            F.col("effective_date_from").alias("staff_from"))
    return fact.join(discs, "inventory_fk").join(people, "staff_fk").select(
        *shown, "inventory_id", "inventory_from", "staff_id", "staff_from", "effective_date_from", "effective_date_to", "is_active")


def fact_payment_star(spark, folder):
    state = star_state(spark, folder, "payment")
    return _with_natural_keys(state, state["core.fact_payment"], ["payment_id", "rental_id", "amount", "payment_date_fk"])


def fact_rental_star(spark, folder):
    state = star_state(spark, folder, "rental")
    return _with_natural_keys(state, state["core.fact_rental"], ["rental_id", "rental_date_fk", "return_date_fk"])


def sales_by_date_star(current_only, spark, folder):
    state = star_state(spark, folder, "payment")
    return marts.star_sales_by_date(state["core.fact_payment"], state["core.dim_date"], current_only)


def sales_by_film_star(current_only, spark, folder):
    state = star_state(spark, folder, "payment")
    return marts.star_sales_by_film(state["core.fact_payment"], state["core.dim_inventory"], current_only)


def first_load_sales_by_date(spark, folder):
    """The smallest whole slice: payments of the first batch, as facts, by calendar day."""
    payments = RetailSource(spark, folder, 1)("payment").select(
        date_key(F.col("payment_date")).alias("payment_date_fk"), "amount")
    return marts.star_sales_by_date(payments, op.describe_days(_data_days(spark, folder)))


# ---------------------------------------------------------------- calendar

def _data_days(spark, folder):
    """All days from the first order to the last shipment."""
    raw = RetailSource(spark, folder).raw
    ends = raw("orders").agg(F.min("o_orderdate").alias("lo")).withColumn(
        "hi", raw("lineitem").agg(F.max("l_shipdate")).scalar())
    return op.days_between(ends, "lo", "hi")


def calendar_full(spark, folder):
    return op.describe_days(_data_days(spark, folder))


def calendar_short(spark, folder):
    return op.describe_days_short(_data_days(spark, folder))


# ---------------------------------------------------------------- vault

def vault_state(spark: SparkSession, folder: str, tables: list[str], hubs: list[str] = (), links: list[str] = (),
                sats: list[str] = (), save: Save = lazily) -> State:
    state = reset(spark, VAULT, tables=[JOURNAL, *[f"edw.{kind}_{n}" for kind, names in
                                                   (("hub", hubs), ("link", links), ("sat", sats)) for n in names]])
    stored = ["rental"] if "rental" in tables and save is not lazily else []
    for source, load_ts in zip(both(spark, folder, *stored), (FIRST_LOAD, SECOND_LOAD), strict=True):
        state = state | vault.stage(source, state[JOURNAL], load_ts, save, tables)
        if hubs:
            state = state | vault.load_hubs(state, save, list(hubs))
        if links:
            state = state | vault.load_links(state, save, list(links))
        if sats:
            state = state | vault.load_satellites(state, load_ts, save, list(sats))
    return state


def hub(name, spark, folder):
    return vault_state(spark, folder, vault.HUB_FEEDS[name], hubs=[name])[f"edw.hub_{name}"]


def link(name, spark, folder):
    return vault_state(spark, folder, [vault.LINK_ENDS[name][0]], links=[name])[f"edw.link_{name}"]


def satellite(name, spark, folder):
    return vault_state(spark, folder, [vault.SATELLITES[name][0]], sats=[name])[f"edw.sat_{name}"]


def rented_film_vault(spark, folder):
    state = vault_state(spark, folder, ["film", "inventory", "rental"], ["film", "inventory", "rental"],
                        ["film_inventory", "rental_inventory"], ["film_static"], save=materialize)
    return vault.load_marts(state, lazily)["mart.rented_film"]


# ---------------------------------------------------------------- generator and checks

def synthetic_rentals(spark, folder):
    source = RetailSource(spark, folder, 1)
    rentals = source.rental_base()
    return op.synthetic_rentals(rentals, source.inventory_base(), source.film_base(), source("customer"),
                                source.raw("supplier"), rentals.count(), seed=7, base=0)


def synthetic_changes(spark, folder):
    source = RetailSource(spark, folder, 1)
    return op.synthetic_changes(source.rental_base(), source.inventory_base(), source("customer"), source.raw("supplier"), SECOND_LOAD, seed=7, base=0)


def dq_declared(spark, folder):
    """Declared primary and foreign keys of star and vault after both loads."""
    sources = both(spark, folder, "payment", "rental")
    reports = [check_state(pipeline_state(name, spark, folder, sources), tables, [layer])
               for name, tables, layer in (("star", STAR, "core"), ("vault", VAULT, "edw"))]
    return reports[0].unionByName(reports[1]).filter(F.col("check").isin("unique", "reference"))


def dq_not_null(spark, folder):
    rentals = align_columns(RetailSource(spark, folder).rental_base(), {"deleted": "timestamp_ntz"})
    return op.check_not_null(rentals, ["rental_id", "rental_date", "return_date", "deleted"])


def dq_domain(spark, folder):
    film = RetailSource(spark, folder)("film")
    return op.check_domain(film, "rating", RATINGS).unionByName(
        op.check_domain(film, "release_year", low=YEARS[0], high=YEARS[1])).unionByName(
        op.check_domain(film, "rental_duration", high=40))


def dq_length(spark, folder):
    return op.check_length(RetailSource(spark, folder)("film"), {"title": 12, "description": 15, "rating": 10})


def dq_unique(spark, folder):
    source = RetailSource(spark, folder)
    return op.check_unique(source.raw("lineitem"), ["l_orderkey", "l_linenumber"]).unionByName(
        op.check_unique(source("payment"), ["payment_id"]))


def dq_reference(spark, folder):
    first, second = both(spark, folder)
    return op.check_reference(first("inventory"), "film_id", first("film"), "film_id").unionByName(
        op.check_reference(second("payment"), "rental_id", second("rental"), "rental_id")).unionByName(
        op.check_reference(second("payment"), "staff_id", second("staff"), "staff_id"))


def dq_asof_misses(spark, folder):
    """Payments that the as-of join with the discs drops, with the reason."""
    dim = materialize(scd2_dim_inventory(spark, folder), "discs")
    return op.as_of_misses(_paid_rentals(spark, folder), dim, "inventory_id", "last_update")


def dq_missing_parents(spark, folder):
    """Changes of the second load that its inner joins drop, since a parent is missing."""
    _, staged = _dims_before(spark, folder)
    source = RetailSource(spark, folder)
    rentals = extract_incremental("rental", spark, folder)
    discs, people = scd2_merge_inventory(spark, folder), scd2_dim_staff(spark, folder)
    reports = {
        "inventory": op.missing_parents(staged["staging.inventory"], "inventory_id", {"film_id": (staged["staging.film"], "film_id")}),
        "staff": op.missing_parents(staged["staging.staff"], "staff_id", {"store_id": (staged["staging.store"], "store_id")}),
        "payment": op.missing_parents(source("payment"), "payment_id", {"rental_id": (source("rental"), "rental_id")}),
        "rental": op.missing_parents(rentals, "rental_id", {"inventory_id": (discs, "inventory_id"), "staff_id": (people, "staff_id")})}
    return reduce(DataFrame.unionByName, [r.select(F.lit(n).alias("table"), "*") for n, r in reports.items()])


# ---------------------------------------------------------------- whole pipelines

_PIPELINES = {"star": (STAR, star.run_star), "corporate": (CORPORATE, corporate.run_corporate), "vault": (VAULT, vault.run_vault)}


def pipeline_state(name: str, spark: SparkSession, folder: str, sources: tuple[RetailSource, RetailSource] | None = None) -> State:
    """State after two whole loads by the pipeline itself; `sources` are the two batches where several pipelines load the same."""
    tables, run = _PIPELINES[name]
    state = reset(spark, tables)
    if name == "star":
        state["core.dim_date"] = op.describe_days(_data_days(spark, folder))
    elif name == "corporate":
        state["mart.calendar"] = _short_calendar(spark, folder)
    stored = ["rental"] if name == "vault" else ["payment", "rental"]  # the vault has no payments
    for source, load_ts in zip(sources or both(spark, folder, *stored), (FIRST_LOAD, SECOND_LOAD), strict=True):
        state = state | run(source, state, load_ts)
    return state


def pipeline_star_fact_payment(spark, folder):
    state = pipeline_state("star", spark, folder)
    return _with_natural_keys(state, state["core.fact_payment"], ["payment_id", "rental_id", "amount", "payment_date_fk"])


def pipeline_star_dim_inventory(spark, folder):
    return _shown(pipeline_state("star", spark, folder)["core.dim_inventory"])


def pipeline_star_sales_by_film(spark, folder):
    return pipeline_state("star", spark, folder)["mart.sales_film"]


def pipeline_corporate_fact_payment(spark, folder):
    return pipeline_state("corporate", spark, folder)["dds.fact_payment"]


def pipeline_corporate_dim_film(spark, folder):
    shown = [c for c in CORPORATE_COLUMNS["film"] if c not in ("last_update", "deleted")]
    return pipeline_state("corporate", spark, folder)["dds.dim_film"].select(*shown, "date_effective_from", "date_effective_to", "is_active")


def pipeline_corporate_sales_by_film(spark, folder):
    return pipeline_state("corporate", spark, folder)["mart.sales_by_film"]


def pipeline_vault_hub_film(spark, folder):
    return pipeline_state("vault", spark, folder)["edw.hub_film"]


def pipeline_vault_sat_rental_dynamic(spark, folder):
    return pipeline_state("vault", spark, folder)["edw.sat_rental_dynamic"]


def pipeline_vault_rented_film(spark, folder):
    return pipeline_state("vault", spark, folder)["mart.rented_film"]


# ---------------------------------------------------------------- registry

def _tuned(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(tune(spark), folder)
    return run


def registered() -> dict[str, Query]:
    found: dict[str, Query] = {q.__name__: q for q in (
        extract_full_film, high_water_mark, record_load, previous_load_time, extract_incremental_payment,
        schema_evolution_align, hash_key_film, hash_diff_film_static, hash_diff_film_dynamic, link_key_inventory,
        link_key_rental, row_hash_changed_film, scd2_soft_delete_inventory, scd2_new_inventory, scd2_version_inventory,
        scd2_dim_staff, scd2_dim_inventory, scd2_split_film_change, as_of_join_payment_inventory, as_of_join_boundary,
        fact_payment_star, fact_rental_star, calendar_full, calendar_short, sales_by_date_corp, sales_by_film_corp,
        mart_reader_by_date, mart_reader_by_film, rented_film_vault, synthetic_rentals, synthetic_changes, dq_declared, dq_not_null, dq_domain, dq_length,
        dq_unique, dq_reference, dq_asof_misses, dq_missing_parents, scd2_merge_inventory, pipeline_star_fact_payment, pipeline_star_dim_inventory,
        pipeline_star_sales_by_film, pipeline_corporate_fact_payment, pipeline_corporate_dim_film,
        pipeline_corporate_sales_by_film, pipeline_vault_hub_film, pipeline_vault_sat_rental_dynamic, pipeline_vault_rented_film)}
    for name in ("inventory", "staff", "rental"):
        found[f"extract_incremental_{name}"] = partial(extract_incremental, name)
    for name in corporate.FACTS:
        found[f"upsert_{name}"] = partial(upsert, name)
        found[f"upsert_since_{name}"] = partial(upsert_since, name)
        found[f"integrated_{name}"] = partial(integrated, name)
        found[f"fact_{name}_corp"] = partial(corporate_fact, name)
    for name in corporate.ENTITIES:
        found[f"sync_keys_{name}"] = partial(sync_keys, name)
        found[f"replace_keys_{name}"] = partial(replace_keys, name)
    for name in corporate.DIMENSIONS:
        found[f"scd2_hash_dim_{name}"] = partial(scd2_hash_dim, name)
    for suffix, current_only in (("", False), ("_current", True)):
        found[f"sales_by_date_star{suffix}"] = partial(sales_by_date_star, current_only)
        found[f"sales_by_film_star{suffix}"] = partial(sales_by_film_star, current_only)
    for name in ("film", "inventory", "rental"):
        found[f"hub_{name}"] = partial(hub, name)
    for name in ("film_inventory", "rental_inventory"):
        found[f"link_{name}"] = partial(link, name)
    for name in vault.SATELLITES:
        found[f"sat_{name}"] = partial(satellite, name)
    return {name: _tuned(query) for name, query in sorted(found.items())}
