"""Whole loads: three batches through a store, invariants, reruns, and key ranges."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from siltstone import operators as op
from siltstone.functions import timestamp
from siltstone.plans import WarehouseStore, common, marts, run_corporate, run_star, run_vault
from siltstone.plans import star as star_plan
from siltstone.plans.catalog import fact_payment_star, fact_rental_star
from siltstone.plans.checks import check_state
from siltstone.schemas import CORPORATE, STAR, VAULT, columns, not_null
from siltstone.session import release
from siltstone.sources import RetailSource
from siltstone.streaming import apply_feed

B1, B2, B3 = "2002-01-01 00:00:00", "2002-02-01 00:00:00", "2002-03-01 00:00:00"


def run(spark, folder, root, tables, pipeline, calendar, loads=((1, B1), (2, B2)), per_range=400):
    store = WarehouseStore(spark, str(root), tables, keys_per_range=per_range)
    for i, (batch, load_ts) in enumerate(loads):
        load, state = store.load(load_ts), store.state()
        if calendar and i == 0:
            state[calendar[0]] = load(calendar[1], calendar[0])
        pipeline(RetailSource(spark, folder, batch), state, load_ts, load)
        load.commit()
    return store


@pytest.fixture(scope="module")
def star(spark, folder, tmp_path_factory):
    calendar = ("core.dim_date", op.calendar(spark, "1995-01-01", 2557))
    return run(spark, folder, tmp_path_factory.mktemp("star"), STAR, run_star, calendar)


@pytest.fixture(scope="module")
def corporate(spark, folder, tmp_path_factory):
    calendar = ("mart.calendar", op.calendar_short(spark, "1995-01-01", 2557))
    return run(spark, folder, tmp_path_factory.mktemp("corp"), CORPORATE, run_corporate, calendar)


@pytest.fixture(scope="module")
def vault(spark, folder, tmp_path_factory):
    return run(spark, folder, tmp_path_factory.mktemp("vault"), VAULT, run_vault, None)


def bag(df, *names):
    return sorted(map(str, df.select(*names).collect()))


def test_star_facts_do_not_depend_on_key_ranges(spark, folder, star):
    """Rewriting only the touched ranges gives what rewriting everything gives."""
    state = star.state()
    for query, table, names in (
            (fact_payment_star, "core.fact_payment", ["payment_id", "amount", "effective_date_from", "effective_date_to", "is_active"]),
            (fact_rental_star, "core.fact_rental", ["rental_id", "return_date_fk", "effective_date_from", "effective_date_to", "is_active"])):
        assert bag(state[table], *names) == bag(query(spark, folder), *names)


def test_star_invariants(star):
    state = star.state()
    for table, key, pk in (("core.dim_inventory", "inventory_id", "inventory_pk"), ("core.dim_staff", "staff_id", "staff_pk"),
                           ("core.fact_rental", "rental_id", "rental_pk"), ("core.fact_payment", "payment_id", "payment_pk")):
        df = state[table]
        assert op.check_unique(df, [pk]).first().violations == 0
        assert df.filter("effective_date_from > effective_date_to").isEmpty()
        if table.startswith("core.dim"):
            assert op.check_unique(df.filter("is_active"), [key]).first().violations == 0
    for table in ("core.fact_payment", "core.fact_rental"):
        for fk, dim, pk in (("inventory_fk", "core.dim_inventory", "inventory_pk"), ("staff_fk", "core.dim_staff", "staff_pk")):
            assert op.check_reference(state[table], fk, state[dim], pk).first().violations == 0


def test_declared_constraints_hold(star, vault):
    for store, tables, layers in ((star, STAR, ["core", "mart"]), (vault, VAULT, ["edw", "mart"])):
        report = check_state(store.state(), tables, layers).collect()
        assert len(report) > 60 and [r for r in report if r.violations] == []


class Later(RetailSource):
    """A third batch: some payments change their amount or day, some are touched, some rentals move to another disc."""

    def _payment(self):
        stamp = "TIMESTAMP_NTZ '2002-02-10 00:00:00'"
        return super()._payment().withColumns({
            "last_update": F.expr(f"CASE WHEN payment_id % 7 = 2 THEN {stamp} ELSE last_update END"),
            "amount": F.expr("CAST(CASE WHEN payment_id % 14 = 2 THEN amount + 3 ELSE amount END AS DECIMAL(12,2))"),
            "payment_date": F.expr("CASE WHEN payment_id % 21 = 2 THEN payment_date + INTERVAL 1 DAY ELSE payment_date END")})

    def _rental(self):
        return super()._rental().withColumns({
            "last_update": F.expr("CASE WHEN rental_id % 11 = 3 THEN TIMESTAMP_NTZ '2002-02-11 00:00:00' ELSE last_update END"),
            "inventory_id": F.expr("CASE WHEN rental_id % 11 = 3 THEN 5L ELSE inventory_id END")})


def test_marts_kept_up_by_changes_equal_the_recomputed_ones(spark, folder, tmp_path):
    """After each of three loads; the fact's old folders aren't read for it."""
    store = WarehouseStore(spark, str(tmp_path), STAR, keys_per_range=400)
    for batch, load_ts in ((RetailSource(spark, folder, 1), B1), (RetailSource(spark, folder, 2), B2), (Later(spark, folder, 2), B3)):
        load, state = store.load(load_ts), store.state()
        if load_ts == B1:
            state["core.dim_date"] = load(op.calendar(spark, "1995-01-01", 2557), "core.dim_date")
        run_star(batch, state, load_ts, load)
        load.commit()
        state = store.state()
        by_date = marts.star_sales_by_date(state["core.fact_payment"], state["core.dim_date"])
        by_film = marts.star_sales_by_film(state["core.fact_payment"], state["core.dim_inventory"])
        assert bag(state["mart.sales_date"], *by_date.columns) == bag(by_date, *by_date.columns)
        assert bag(state["mart.sales_film"], *by_film.columns) == bag(by_film, *by_film.columns)
    again = star_plan.rebuild_marts(state, lambda df, name: df)
    for table in ("mart.date_sums", "mart.film_sums", "mart.sales_date", "mart.sales_film"):
        assert bag(again[table], *state[table].columns) == bag(state[table], *state[table].columns)
    changes = {star_plan.CHANGES: spark.createDataFrame([(20020101, 1, 1, 1)], "payment_date_fk int, inventory_fk long, amount int, sign int")}
    kept = star_plan.load_marts(state | changes, lambda df, name: df)
    assert not any("fact_payment" in f for df in kept.values() for f in df.inputFiles())


def test_untouched_ranges_are_not_rewritten(spark, folder, tmp_path):
    """A delta with few keys leaves the folders of the other ranges as they are."""
    store = WarehouseStore(spark, str(tmp_path), CORPORATE, keys_per_range=100)
    rows = RetailSource(spark, folder, 1)("payment").select(*[c for c in (
        "payment_id", "customer_id", "staff_id", "rental_id", "amount", "payment_date", "deleted", "last_update")])
    first = store.load(B1)
    first(rows, "ods.payment")
    first.commit()
    before = store.last_commit()["ods.payment"]
    delta = rows.filter("payment_id between 150 and 160").withColumn("amount", F.lit(1).cast("decimal(12,2)"))
    load, target = store.load(B2), store.state()["ods.payment"]
    load(op.upsert(load.narrow(target, "ods.payment", delta), delta, "payment_id"), "ods.payment")
    load.commit()
    after = store.last_commit()["ods.payment"]
    assert {p for p in after if after[p] != before.get(p)} == {1} and len(after) == len(before) > 5
    result = store.state()["ods.payment"]
    assert result.count() == rows.count()
    assert result.filter("amount = 1").count() == delta.count()


def test_used_load_time_is_refused(spark, folder, star):
    with pytest.raises(ValueError, match="not after the last load"):
        run_star(RetailSource(spark, folder, 2), star.state(), B2, star.load(B2))


def test_failed_load_stays_invisible(spark, star):
    before = star.last_commit()
    load = star.load(B3)
    load(star.state()["mart.sales_film"].limit(1), "mart.sales_film")
    assert star.last_commit() == before
    with pytest.raises(KeyError):
        load(spark.range(1), "mart.unknown")


def test_corporate_invariants_and_rerun(spark, folder, corporate):
    before = corporate.state()
    for name in ("film", "inventory", "address", "city", "staff", "store", "payment", "rental"):
        ref = before[f"ref.{name}"]
        top, n, distinct = ref.agg(F.max(f"{name}_sk"), F.count("*"), F.countDistinct(f"{name}_nk")).first()
        assert top == n == distinct
    for name in ("film", "inventory", "address", "city", "staff", "store"):
        live = before[f"dds.dim_{name}"].filter("is_active")
        assert op.check_unique(live, [f"{name}_id"]).first().violations == 0
    # the same source once more: nothing changes but soft-deleted rows that are extracted again
    load = corporate.load(B3)
    after = run_corporate(RetailSource(spark, folder, 2), before, B3, load)
    for table in [t for t in CORPORATE if t.split(".")[0] in ("ref", "dds", "mart")]:
        names = [c for c in after[table].columns]
        assert bag(after[table], *names) == bag(before[table], *names), table


def test_vault_invariants(vault):
    state = vault.state()
    for table, key in (("edw.hub_film", ["hub_film_hash_key"]), ("edw.hub_inventory", ["hub_inventory_hash_key"]),
                       ("edw.hub_rental", ["hub_rental_hash_key"]), ("edw.link_film_inventory", ["link_film_inventory_hash_key"]),
                       ("edw.link_rental_inventory", ["link_rental_inventory_hash_key"]),
                       ("edw.sat_film_static", ["hub_film_hash_key", "load_date"]),
                       ("edw.sat_rental_dynamic", ["hub_rental_hash_key", "load_date"])):
        assert op.check_unique(state[table], key).first().violations == 0
        assert all(r.violations == 0 for r in op.check_not_null(state[table], not_null(VAULT, table)).collect())
    for child, fk, parent in (("edw.link_film_inventory", "hub_film_hash_key", "edw.hub_film"),
                              ("edw.link_rental_inventory", "hub_inventory_hash_key", "edw.hub_inventory"),
                              ("edw.sat_film_static", "hub_film_hash_key", "edw.hub_film")):
        assert op.check_reference(state[child], fk, state[parent], fk).first().violations == 0


def test_vault_store_equals_whole_rewrites(spark, folder, vault):
    """Appended folders and rewritten parts give what the plain operators give."""
    from siltstone.plans import catalog
    state = vault.state()
    for name, query in ([(f"edw.sat_{n}", lambda n=n: catalog.satellite(n, spark, folder)) for n in ("film_static", "inventory", "rental_dynamic")]
                        + [("edw.hub_inventory", lambda: catalog.hub("inventory", spark, folder)),
                           ("edw.link_film_inventory", lambda: catalog.link("film_inventory", spark, folder))]):
        expected = query()
        assert bag(state[name], *expected.columns) == bag(expected, *expected.columns), name
    parts = vault.last_commit()
    assert len(parts["edw.hub_rental"]) == len(parts["edw.sat_rental_dynamic"]) == 2


def test_returning_keys(spark):
    """A key that left and comes back: the vault and the star open it again, the hash dimension does not."""
    key = spark.range(1).select(F.lit(7).cast("bigint").alias("film_id"), F.lit("A").alias("title"))
    snapshot = key.withColumn("last_update", timestamp("2002-01-10"))
    gone = snapshot.filter("film_id < 0")
    dim = spark.sql("SELECT CAST(NULL AS BIGINT) film_id, CAST(NULL AS STRING) title, CAST(NULL AS TIMESTAMP_NTZ) date_effective_from, "
                    "CAST(NULL AS TIMESTAMP_NTZ) date_effective_to, CAST(NULL AS BOOLEAN) is_active, CAST(NULL AS STRING) hash WHERE FALSE")
    for rows, ts in ((snapshot, B1), (gone, B2), (snapshot, B3)):
        dim = op.scd2_hash(dim, rows, "film_id", ts)
    assert [(r.is_active, str(r.date_effective_to)) for r in dim.collect()] == [(False, B2)]
    sat = spark.sql("SELECT CAST(NULL AS BIGINT) film_id, CAST(NULL AS TIMESTAMP_NTZ) load_date, CAST(NULL AS TIMESTAMP_NTZ) load_end_date, "
                    "CAST(NULL AS STRING) record_source, CAST(NULL AS STRING) title WHERE FALSE")
    for rows, ts in ((snapshot, B1), (gone, B2), (snapshot, B3)):
        staged = rows.withColumns({"load_date": timestamp(ts), "record_source": F.lit("x")})
        sat = op.load_plain_satellite(sat, staged, "film_id", ["title"], ts)
    assert sorted((str(r.load_date), str(r.load_end_date)) for r in sat.collect()) == [(B1, B2), (B3, "None")]


def _payments(spark, folder):
    return RetailSource(spark, folder, 1)("payment").select(*columns(CORPORATE, "ods.payment"))


def _load(store, rows, load_ts, table="ods.payment"):
    load = store.load(load_ts)
    load(rows, table)
    load.commit()


def test_another_range_width_is_refused(spark, folder, tmp_path):
    rows = _payments(spark, folder)
    _load(WarehouseStore(spark, str(tmp_path), CORPORATE, keys_per_range=100), rows, B1)
    with pytest.raises(ValueError, match="ranges of 100"):
        WarehouseStore(spark, str(tmp_path), CORPORATE, keys_per_range=1000).load(B2)
    store = WarehouseStore(spark, str(tmp_path), CORPORATE)  # the recorded width is taken
    delta = rows.filter("payment_id between 150 and 160")
    load, target = store.load(B2), store.state()["ods.payment"]
    load(op.upsert(load.narrow(target, "ods.payment", delta), delta, "payment_id"), "ods.payment")
    load.commit()
    assert bag(store.state()["ods.payment"], *rows.columns) == bag(rows, *rows.columns)


def test_load_times_are_moments_not_texts(spark, folder, tmp_path):
    rows, store = _payments(spark, folder), WarehouseStore(spark, str(tmp_path), CORPORATE)
    for n, load_ts in ((10, "2002-9-30"), (20, "2002-10-01"), (30, "2002-10-01 00:00:00.000001"), (40, "2002-10-01 00:00:00.000002")):
        _load(store, rows.limit(n), load_ts)
        assert store.state()["ods.payment"].count() == n
    for used in ("2002-09-30", "2002-10-01 00:00:00.000002", "2002-10-1"):
        assert store.is_loaded(used)
        with pytest.raises(ValueError, match="not after"):
            store.load(used)


def test_satellites_take_loads_within_a_second(spark, folder, tmp_path):
    store = WarehouseStore(spark, str(tmp_path), VAULT)
    for batch, load_ts in ((1, "2002-01-01 00:00:00.000001"), (2, "2002-01-01 00:00:00.5")):
        load, state = store.load(load_ts), store.state()
        run_vault(RetailSource(spark, folder, batch), state, load_ts, load)
        load.commit()
    assert len(store.last_commit()["edw.sat_film_static"]) == 2
    assert op.check_unique(store.state()["edw.sat_film_static"], ["hub_film_hash_key", "load_date"]).first().violations == 0


def test_a_failed_load_can_be_repeated_and_cleaned_up(spark, folder, tmp_path):
    rows, store = _payments(spark, folder), WarehouseStore(spark, str(tmp_path), CORPORATE, keys_per_range=500)
    crashed = store.load(B1)
    crashed(rows.limit(5), "ods.payment")  # no commit
    (tmp_path / "_commits" / "000000000001").mkdir(parents=True)  # and one that broke off while committing
    _load(store, rows, B1)
    assert bag(store.state()["ods.payment"], *rows.columns) == bag(rows, *rows.columns)
    assert store.clean() == 1 and store.clean() == 0
    assert store.state()["ods.payment"].count() == rows.count()


@pytest.mark.parametrize("crash", ["before", "after"])
def test_feed_goes_on_after_a_crash(spark, folder, tmp_path, crash):
    """A driver lost before or just after the commit: the batch given again counts once."""
    rows, store, tries = _payments(spark, folder), WarehouseStore(spark, str(tmp_path / "store"), CORPORATE), []
    rows.coalesce(1).write.parquet(str(tmp_path / "feed"))

    def time_of(batch_id):
        return f"2002-03-01 00:00:{batch_id:02d}"

    def load(delta, batch_id):
        tries.append(batch_id)
        begun = store.load(time_of(batch_id))
        begun(delta, "ods.payment")
        if crash == "before" and len(tries) == 1:
            raise RuntimeError("lost")
        begun.commit()
        if len(tries) == 1:
            raise RuntimeError("lost")

    def feed():
        apply_feed(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "feed")), load, str(tmp_path / "checkpoint"),
                   lambda i: store.is_loaded(time_of(i)))
    with pytest.raises(Exception, match="lost"):
        feed()
    feed()
    assert len(tries) == (2 if crash == "before" else 1)
    assert bag(store.state()["ods.payment"], *rows.columns) == bag(rows, *rows.columns)


def test_steps_release_the_driver_and_loads_take_turns(spark, folder, tmp_path, monkeypatch):
    """What a step leaves behind goes before the next one begins, and few loads of a step are held by the driver at once."""
    events, running, lock = [], [], threading.Lock()
    monkeypatch.setattr(common, "release", lambda s: events.append("release"))
    load = WarehouseStore(spark, str(tmp_path), VAULT).load(B1)

    def save(df, table):
        with lock:
            running.append(table)
            events.append((table.split("_")[0], len(running)))
        try:
            return load(df, table)
        finally:
            running.remove(table)

    run_vault(RetailSource(spark, folder, 1), WarehouseStore(spark, str(tmp_path), VAULT).state(), B1, save)
    steps = [[]]
    for e in events:
        steps.append([]) if e == "release" else steps[-1].append(e)
    assert [{table for table, _ in step} for step in steps] == [{"staging.film", "staging.inventory", "staging.rental", "staging.last"}, {"edw.hub"}, {"edw.link"}, {"edw.sat"}, {"mart.rented"}, set()]
    assert max(n for step in steps for _, n in step) <= common.SIDE_BY_SIDE < 8


def test_release_frees_what_nothing_holds(spark):
    jvm = spark.sparkContext._jvm
    weak = jvm.java.lang.ref.WeakReference(jvm.java.util.ArrayList())
    for _ in range(20):  # Python tells the JVM a little later what it has dropped
        release(spark)
        if weak.refersTo(None):
            break
        time.sleep(0.2)
    assert weak.refersTo(None)
