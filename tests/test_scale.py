"""Plans: filters and columns reach the scan, hot keys are split, nothing runs in one task."""

import importlib

import pytest
from pyspark.sql import functions as F

from siltstone import materialize
from siltstone import operators as op
from siltstone.operators import asof, facts
from siltstone.plans import common, corporate, marts
from siltstone.schemas import CORPORATE, STAR, columns, reset
from siltstone.sources import RetailSource

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
SMALL_SKEW = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
              "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB"}


@pytest.fixture
def conf(spark):
    changed = {}

    def change(values):
        for name, value in values.items():
            changed.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)
    yield change
    for name, value in changed.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    execution = df._jdf.queryExecution()
    execution.executedPlan().execute().count()
    return execution.executedPlan().toString()


def test_extract_is_pushed_into_the_scan(spark, folder, tmp_path):
    RetailSource(spark, folder)("rental").write.parquet(str(tmp_path / "rental.parquet"))
    source = spark.read.parquet(str(tmp_path / "rental.parquet"))
    text = plan(op.extract_incremental(source, ["rental_id", "last_update"], "2002-01-01 00:00:00"))
    assert "GreaterThanOrEqual(last_update,2002-01-01T00:00)" in text and "GreaterThanOrEqual(deleted,2002-01-01T00:00)" in text
    assert "ReadSchema: struct<rental_id:bigint,last_update:timestamp_ntz,deleted:timestamp_ntz>" in text
    assert "Exchange" not in text


def test_both_sides_of_the_enriched_extract_are_pushed(spark, folder, tmp_path):
    source = RetailSource(spark, folder)
    for name in ("payment", "rental"):
        source(name).write.parquet(str(tmp_path / name))
    payment, rental = (spark.read.parquet(str(tmp_path / n)) for n in ("payment", "rental"))
    df = op.extract_incremental_enriched(payment, rental, "rental_id", ["inventory_id"], list(columns(STAR, "staging.payment")),
                                         "2002-01-01 00:00:00")
    text = plan(df)
    # the changed payments and the changed rentals
    assert text.count("GreaterThanOrEqual(last_update,2002-01-01T00:00)") == 2
    assert "Union" in text and df.count() == df.select("payment_id").distinct().count()


def test_newer_than_target_is_a_subquery_of_the_scan(spark, folder, tmp_path):
    RetailSource(spark, folder)("payment").write.parquet(str(tmp_path / "p"))
    source = spark.read.parquet(str(tmp_path / "p"))
    assert "GreaterThan(last_update,ScalarSubquery" in plan(op.changes_since_target(source, source))


@pytest.fixture
def hot(spark):
    """A third of the facts carry one disc."""
    n = 60000
    facts = materialize(spark.range(n).select(
        F.col("id").alias("payment_id"), F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).cast("bigint").alias("inventory_id"),
        F.expr("timestamp_ntz'2002-01-05 00:00:00'").alias("last_update"), F.md5(F.col("id").cast("string")).alias("pad")))
    dim = materialize(spark.range(5000).select(
        F.col("id").alias("inventory_id"), F.expr("timestamp_ntz'1900-01-01 00:00:00'").alias("effective_date_from"),
        F.expr("timestamp_ntz'2199-01-01 00:00:00'").alias("effective_date_to"), F.col("id").alias("inventory_pk"), F.lit(True).alias("is_active")))
    return facts, dim


def test_hot_key_and_moment_are_spread_in_the_as_of_join(spark, conf):
    """100,000 versions of one key within one hour, a third of the facts on it, half of these at one moment: no slice of the stream
    has much more than its share, and each fact meets its version."""
    conf(NO_BROADCAST)
    first = "TIMESTAMP_NTZ '2002-01-05 00:00:00'"
    dim = spark.range(100_000).selectExpr("7L AS k", f"timestampadd(MILLISECOND, CAST(id AS INT) * 36, {first}) AS effective_date_from",
                                          f"timestampadd(MILLISECOND, CAST(id AS INT) * 36 + 36, {first}) AS effective_date_to", "id AS v")
    dim = dim.unionByName(spark.range(100, 5000).selectExpr("id AS k", "TIMESTAMP_NTZ '1900-01-01' AS effective_date_from",
                                                            "TIMESTAMP_NTZ '2199-01-01' AS effective_date_to", "id AS v"))
    facts = spark.range(90_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7L ELSE 100 + id % 4900 END AS k",
                                           f"timestampadd(MILLISECOND, CASE WHEN id % 2 = 0 THEN 1000 ELSE CAST(id AS INT) * 36 + 5 END, {first}) AS at")
    stream = asof._stream(facts, dim, "k", "at", {"v": "v"}, "left", op.STAR_SPAN)
    sizes = [r[0] for r in stream.rows.groupBy("_part").count().select("count").collect()]
    assert sum(sizes) == 194_900 and max(sizes) < 1.5 * sum(sizes) / len(sizes)
    got = op.as_of_join(facts, dim, "k", "at", {"v": "v"}, "left")
    wrong = got.filter("v <> CASE WHEN k <> 7 THEN k WHEN id % 2 = 0 THEN 27 ELSE id END")
    assert got.count() == 90_000 and wrong.isEmpty()
    for node in ("NestedLoop", "Cartesian", "Python"):
        assert node not in plan(got)


def test_hot_key_is_split_when_keys_are_replaced(spark, conf, hot):
    conf(NO_BROADCAST | SMALL_SKEW)
    facts, dim = hot
    known = op.Registry(dim.select("inventory_pk", "inventory_id"), "inventory_pk", "inventory_id")
    df = op.replace_keys(facts, {"inventory_id": known})
    assert "skew=true" in final_plan(df) and df.count() == 60000


def test_hot_parent_is_split_when_versions_are_split(spark, conf, hot):
    conf(NO_BROADCAST | SMALL_SKEW)
    facts, _ = hot
    dim = facts.select(F.col("payment_id").alias("inventory_id"), F.col("inventory_id").alias("film_id"), F.col("pad").alias("title"),
                       F.expr("timestamp_ntz'1900-01-01 00:00:00'").alias("effective_date_from"),
                       F.expr("timestamp_ntz'2199-01-01 00:00:00'").alias("effective_date_to"), F.lit(True).alias("is_active"))
    films = materialize(spark.range(5000).select(F.col("id").alias("film_id"), F.lit("new").alias("title"),
                                                 F.expr("timestamp_ntz'2002-01-12 00:00:00'").alias("last_update")))
    df = op.scd2_split(dim, films, "film_id", ["title"])
    assert "skew=true" in final_plan(df)
    assert df.count() == 120000 and df.filter("is_active").filter("title <> 'new'").isEmpty()


def test_mart_is_summed_before_it_is_shuffled(spark, hot, conf):
    conf(NO_BROADCAST)
    facts, dim = hot
    fact = facts.select(F.col("inventory_id").alias("inventory_fk"), F.lit(1).cast("decimal(12,2)").alias("amount"), F.lit(True).alias("is_active"))
    df = marts.star_sales_by_film(fact, dim.withColumn("title", F.lit("one title")))
    assert df.first().amount == 60000
    text = plan(df)
    assert text.index("SortMergeJoin") < text.rindex("partial_sum")


@pytest.mark.parametrize("name", ["scd2_dim_inventory", "scd2_hash_dim_inventory", "fact_payment_star", "sat_film_static", "hub_film",
                                  "extract_incremental_payment", "upsert_payment"])
def test_no_nested_loops_and_no_python(spark, folder, name, conf):
    import __spark_entry__ as entry
    conf(NO_BROADCAST)
    text = plan(entry.queries()[name](spark, folder))
    for node in ("NestedLoop", "Cartesian", "Python", "Arrow"):
        assert node not in text


def _span(at, start, end):
    return {f"{at}_from": F.lit(start).cast("timestamp_ntz"), f"{at}_to": F.lit(end).cast("timestamp_ntz")}


def test_ended_versions_are_not_shuffled_by_a_snapshot(spark, conf, tmp_path):
    """SCD-5: of history only keys are dealt out, and of these only such as a key without a live version may be."""
    conf(NO_BROADCAST)
    dim = spark.range(1000).withColumns({"v": F.md5(F.col("id").cast("string")), "is_active": F.col("id") % 2 == 0, "hash": F.lit("h"),
                                         **_span("date_effective", "1900-01-01", "2199-01-01")})
    dim.write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim"))
    snapshot = spark.range(5, 1100).select("id", F.lit("w").alias("v"), F.lit("2002-01-01").cast("timestamp_ntz").alias("last_update"))
    df = op.scd2_hash(dim, snapshot, "id", "2002-02-01 00:00:00")
    # history of 500; live rows: 3 gone, 497 changed to two; 100 new keys
    assert df.count() == 500 + 3 + 2 * 497 + 100 and df.filter("is_active").count() == 497 + 100
    tree = df._jdf.queryExecution().optimizedPlan().toString()
    assert tree.count("FullOuter") == 1 and "might" not in tree
    for line in plan(df).splitlines():
        assert "NestedLoop" not in line and "Cartesian" not in line


def test_payments_that_no_change_reaches_pass_by(spark, conf, tmp_path):
    """FCT-1: a load with few payments deals out few rows of a large fact, and reads none of it twice for a join."""
    conf(NO_BROADCAST)
    fact = spark.range(20_000).select(
        F.col("id").alias("payment_pk"), F.col("id").alias("payment_id"), F.col("id").alias("rental_id"), F.lit(1).cast("decimal(12,2)").alias("amount"),
        F.lit(20020101).alias("payment_date_fk"), F.lit(1).cast("bigint").alias("inventory_fk"), F.lit(1).cast("bigint").alias("staff_fk"),
        *[c.alias(n) for n, c in _span("effective_date", "1900-01-01", "2199-01-01").items()], F.lit(True).alias("is_active"))
    fact.write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    discs, people = ((spark.range(1, 2).select(F.col("id").alias(f"{n}_pk"), F.col("id").alias(f"{n}_id"), F.lit(True).alias("is_active"),
                                               *[c.alias(k) for k, c in _span("effective_date", "1900-01-01", "2199-01-01").items()])) for n in ("inventory", "staff"))
    staged = spark.range(19_990, 20_010).select(
        F.col("id").alias("payment_id"), F.lit(1).cast("bigint").alias("staff_id"), F.col("id").alias("rental_id"), F.lit(1).cast("bigint").alias("inventory_id"),
        F.lit(2).cast("decimal(12,2)").alias("amount"), F.lit("2002-01-01").cast("timestamp_ntz").alias("payment_date"),
        F.lit("2002-01-05").cast("timestamp_ntz").alias("last_update"), F.lit(None).cast("timestamp_ntz").alias("deleted"))
    past, merged = facts.merge_payments(fact, staged, discs, people, op.calendar(spark, "2002-01-01", 31))
    assert past.count() > 19_900 and merged.count() < 150 and "Exchange" not in plan(past).split("Subquery")[0]
    whole = op.load_fact_payment(fact, staged, discs, people, op.calendar(spark, "2002-01-01", 31))
    assert whole.count() == 20_020 and whole.filter("is_active AND amount = 2").count() == 20


def test_satellite_is_one_join(spark, conf):
    """DV-3: open rows and staged rows meet once; ended rows pass by."""
    conf(NO_BROADCAST)
    rows = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit("2002-01-01").cast("timestamp_ntz").alias("load_date"),
                                   F.when(F.col("id") % 2 == 0, F.lit("2002-01-02").cast("timestamp_ntz")).alias("load_end_date"), F.lit("s").alias("record_source"),
                                   F.lit("d").alias("hash_diff"), F.col("id").alias("v"))
    sat = materialize(rows)
    staged = materialize(rows.filter("v >= 10").select("k", F.lit("2002-02-01").cast("timestamp_ntz").alias("load_date"), "record_source",
                                                       F.when(F.col("v") < 50, "e").otherwise("d").alias("diff"), "v"))
    df = op.load_satellite(sat, staged, "k", "diff", ["v"], "2002-02-01 00:00:00")
    text = plan(df)
    assert text.count("FullOuter") == 1 and text.count("Exchange hashpartitioning") == 2
    # 50 ended pass by, 5 open ones are gone, 20 changed, 25 kept; ended keys from 10 on come back
    assert df.count() == 50 + 5 + 2 * 20 + 25 + 45 and df.filter("load_end_date IS NULL").count() == 20 + 25 + 45


def _few_versions(spark):
    dim = spark.range(40).selectExpr("id AS k", "TIMESTAMP_NTZ '1900-01-01' AS effective_date_from", "TIMESTAMP_NTZ '2002-01-05' AS effective_date_to", "id AS v")
    dim = dim.unionByName(dim.selectExpr("k", "effective_date_to AS effective_date_from", "TIMESTAMP_NTZ '2199-01-01' AS effective_date_to", "v + 100 AS v"))
    return spark.range(120).selectExpr("id", "id % 41 AS k", "TIMESTAMP_NTZ '2002-01-04' + make_interval(0, 0, 0, CAST(id % 3 AS INT)) AS at"), dim


@pytest.mark.parametrize("closed", ["both", "left"])
def test_keys_with_few_versions_are_dealt_once_by_the_as_of_join(spark, conf, monkeypatch, closed):
    """F8: no stream is sorted and written for them; a large dimension isn't broadcast for the size of its files."""
    facts, dim = _few_versions(spark)
    want = sorted((r, v) for r in range(120) if r % 41 < 40 for v, hit in ((r % 41, r % 3 <= (closed == "both")), (r % 41 + 100, r % 3 >= 1)) if hit)
    with monkeypatch.context() as patch:
        patch.setattr(asof, "_stream", lambda *_: pytest.fail("sorted into a stream"))
        got = op.as_of_join(facts, dim, "k", "at", {"v": "v"}, closed)
        assert sorted((r.id, r.v) for r in got.collect()) == want
        patch.setattr(asof, "MANY", 10)
        merged = op.as_of_join(facts, dim, "k", "at", {"v": "v"}, closed)
        assert "BroadcastHashJoin" not in plan(merged) and plan(merged).count("Exchange") == 2
        assert sorted((r.id, r.v) for r in merged.collect()) == want


def test_only_keys_with_many_versions_make_a_stream(spark, monkeypatch):
    facts, dim = _few_versions(spark)
    dim = dim.unionByName(spark.range(30).selectExpr("7L AS k", "TIMESTAMP_NTZ '2002-01-05' AS effective_date_from", "TIMESTAMP_NTZ '2002-01-06' AS effective_date_to", "1000 + id AS v"))
    sorted_facts, stream = [], asof._stream
    monkeypatch.setattr(asof, "_stream", lambda f, *rest: sorted_facts.append(f.select("k").distinct().collect()) or stream(f, *rest))
    got = op.as_of_join(facts, dim, "k", "at", {"v": "v"})
    assert [[r.k for r in rows] for rows in sorted_facts] == [[7]]
    hits = [r for r in range(120) if r % 41 == 7]
    assert sorted(r.id for r in got.filter("v >= 1000").collect()) == sorted(r for r in hits if r % 3 for _ in range(30))
    assert got.filter("v < 1000").count() == op.as_of_join(facts, _few_versions(spark)[1], "k", "at", {"v": "v"}).count()


@pytest.mark.parametrize("few", [True, False])
def test_upsert_shuffles_only_the_part_that_it_may_change(spark, conf, tmp_path, few):
    """a target is not dealt out as a whole for the keys of a change, nor for the few rows that a full copy leaves."""
    conf(NO_BROADCAST)
    spark.range(20_000).selectExpr("id AS payment_id", "'old' AS v").unionByName(spark.sql("SELECT CAST(k AS BIGINT) AS payment_id, 'old' AS v FROM VALUES (NULL), (7), (19999) AS t(k)")).write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    keys = spark.range(20).selectExpr("id AS k") if few else spark.range(19_990).selectExpr("id AS k")
    delta = materialize(keys.selectExpr("k AS payment_id", "'new' AS v").unionByName(spark.sql("SELECT CAST(k AS BIGINT) AS payment_id, 'new' AS v FROM VALUES (NULL), (3) AS t(k)")))
    got = op.upsert(target, delta, "payment_id", few=few)
    assert got.exceptAll(op.upsert(target, delta, "payment_id")).isEmpty() and op.upsert(target, delta, "payment_id").exceptAll(got).isEmpty()
    assert got.count() == 20_003 - (21 if few else 19_991) + delta.count()
    joined = got._jdf.queryExecution().optimizedPlan().toString().split("Join Left")[1]
    assert joined.startswith("Anti" if few else "Semi") and "scalar-subquery" in joined.split("Relation")[0]


def test_few_surrogates_are_broadcast_to_the_facts(spark, conf, monkeypatch):
    """a registry of 500,000 keys at most does not make a whole fact move; facts' own registries are never counted."""
    conf(NO_BROADCAST)
    state = reset(spark, CORPORATE)
    for name in ("staff", "payment"):
        state[f"ods.{name}"] = spark.range(50).select(F.col("id").alias(f"{name}_id"))
    facts = spark.range(100).select((F.col("id") % 50).alias("payment_id"), (F.col("id") % 50).alias("staff_id"))
    for bound, broadcast in ((500_000, True), (10, False)):
        monkeypatch.setattr(common, "SMALL", bound)
        done = state | corporate.load_registries(state, common.lazily, ["staff", "payment"])
        for column, name, want in (("staff_id", "staff", broadcast), ("payment_id", "payment", False)):
            df = op.replace_keys(facts, {column: corporate.registry(done, name)})
            assert (f"SortMergeJoin [{column}" not in plan(df)) is want and df.count() == 100
    again = done | corporate.load_registries(done, common.lazily, ["staff"])
    assert again["ref.staff"].count() == 50


def test_many_keys_are_not_broadcast_however_small_their_files(spark, monkeypatch):
    """The bounds count keys. Files of keys that follow each other are a fiftieth of what the driver would hold of them."""
    state = reset(spark, CORPORATE)
    state["ods.staff"] = spark.range(50).select(F.col("id").alias("staff_id"))
    facts = spark.range(100).select(F.col("id").alias("payment_id"), (F.col("id") % 50).alias("staff_id"))
    for bound, merged in ((10, True), (500_000, False)):
        monkeypatch.setattr(common, "SMALL", bound)
        monkeypatch.setattr(importlib.import_module("siltstone.operators.upsert"), "MANY", bound)
        done = state | corporate.load_registries(state, common.lazily, ["staff"])
        given = op.replace_keys(facts, {"staff_id": corporate.registry(done, "staff")})
        assert ("BroadcastHashJoin [staff_id" not in plan(given)) is merged and given.count() == 100
        for few in (True, False):
            kept = op.upsert(facts, facts.filter("payment_id < 20"), "payment_id", few=few)
            assert ("BroadcastHashJoin [payment_id" not in plan(kept)) is merged and kept.count() == 100


def _payments(spark, tmp_path, keys, staged_keys, disc="1L"):
    """A fact of live payments with these keys, and staged ones that change their amounts."""
    span = list(_span("effective_date", "1900-01-01", "2199-01-01").items())
    fact = keys.select("id", F.lit(1).cast("decimal(12,2)").alias("amount"), F.lit(20020101).alias("payment_date_fk"), F.lit(1).cast("bigint").alias("inventory_fk"),
                       F.lit(1).cast("bigint").alias("staff_fk"), *[c.alias(n) for n, c in span], F.lit(True).alias("is_active"))
    fact = fact.selectExpr("id AS payment_pk", "id AS payment_id", "id AS rental_id", "* EXCEPT (id)")
    stamp = "CAST('2002-01-05' AS TIMESTAMP_NTZ)"
    staged = staged_keys.selectExpr("id AS payment_id", "1L AS staff_id", "id AS rental_id", f"{disc} AS inventory_id", "CAST(2 AS DECIMAL(12,2)) AS amount",
                                    "CAST('2002-01-01' AS TIMESTAMP_NTZ) AS payment_date", f"{stamp} AS last_update", "CAST(NULL AS TIMESTAMP_NTZ) AS deleted")
    staged.write.parquet(str(tmp_path / "staged"))
    dims = [spark.range(1, 2).select(F.col("id").alias(f"{n}_pk"), F.col("id").alias(f"{n}_id"), F.lit(True).alias("is_active"), *[c.alias(k) for k, c in span])
            for n in ("inventory", "staff")]
    return fact, spark.read.parquet(str(tmp_path / "staged")), *dims, op.calendar(spark, "2002-01-01", 31)


def test_a_first_load_of_payments_reads_and_deals_them_once(spark, conf, tmp_path):
    """each staged payment is one row of what is dealt by payment; the windows' arguments don't travel with it."""
    conf(NO_BROADCAST)
    _, staged, *context = _payments(spark, tmp_path, spark.range(0), spark.range(1000).unionByName(spark.range(3)))
    empty = reset(spark, STAR, tables=["core.fact_payment"])["core.fact_payment"]
    past, merged = facts.merge_payments(empty, staged, *context)
    text = plan(merged)
    assert text.count("FileScan") == 1 and text.count("+- Window") == 1
    dealt = [line for line in text.splitlines() if "Exchange hashpartitioning(payment_id" in line]
    assert len(dealt) == 1 and "_w0" not in text.split(dealt[0])[1]
    assert past.isEmpty() and merged.count() == 1003 and merged.filter("_was IS NOT NULL OR inventory_fk <> 1 OR staff_fk <> 1").isEmpty()


def test_payments_pass_by_beside_many_staged_ones(spark, tmp_path):
    """the filter of the staged payments has bits for all of them, so it doesn't fill up as a load grows."""
    fact, staged, *context = _payments(spark, tmp_path, spark.range(400_000), spark.range(0, 400_000, 2))
    past, merged = facts.merge_payments(fact, staged, *context)
    assert past.count() > 175_000 and past.count() + merged.count() == 600_000


def test_staged_payments_without_a_disc_still_mark_their_payment(spark, tmp_path):
    fact, staged, *context = _payments(spark, tmp_path, spark.range(5), spark.range(3, 8), disc="CASE id WHEN 4 THEN 9L WHEN 5 THEN NULL ELSE 1L END")
    got = sorted((r.payment_id, int(r.amount), r.is_active) for r in op.load_fact_payment(fact, staged, *context).collect())
    assert got == [(0, 1, True), (1, 1, True), (2, 1, True), (3, 1, False), (3, 2, True), (4, 1, False), (6, 2, True), (7, 2, True)]


def test_rentals_that_no_change_reaches_pass_by(spark, conf, tmp_path):
    """of a large fact only live rentals that a filter of the staged ones knows are dealt out."""
    conf(NO_BROADCAST)
    _, _, discs, people, calendar = _payments(spark, tmp_path, spark.range(0), spark.range(1))
    fact = spark.range(20_000).select(
        F.col("id").alias("rental_pk"), F.col("id").alias("rental_id"), F.lit(20020101).alias("rental_date_fk"), F.lit(20020102).alias("return_date_fk"),
        F.lit(1).cast("bigint").alias("inventory_fk"), F.lit(1).cast("bigint").alias("staff_fk"),
        *[c.alias(n) for n, c in _span("effective_date", "1900-01-01", "2199-01-01").items()], (F.col("id") % 2 == 0).alias("is_active"))
    staged = spark.range(19_990, 20_010).selectExpr(
        "id AS rental_id", "TIMESTAMP_NTZ '2002-01-01' AS rental_date", "1L AS inventory_id", "TIMESTAMP_NTZ '2002-01-03' AS return_date", "1L AS staff_id",
        "TIMESTAMP_NTZ '2002-01-05' AS last_update", "CASE WHEN id = 19992 THEN TIMESTAMP_NTZ '2002-01-04' END AS deleted")
    got = op.load_fact_rental(fact, staged, discs, people, calendar)
    joined = got._jdf.queryExecution().optimizedPlan().toString().split("Join LeftOuter")[1]
    assert "scalar-subquery" in joined.split("Range")[0]
    # live ones: five staged end, one of them by deletion; nine known and ten new ones get a version
    assert got.count() == 20_000 + 9 + 10 and got.filter("is_active").count() == 10_000 - 5 + 9 + 10
    assert got.filter("NOT is_active AND effective_date_to < TIMESTAMP_NTZ '2100-01-01'").count() == 5
