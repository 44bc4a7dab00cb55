"""What the large joins shuffle, and that odd keys come through it whole."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltstone.functions.hashing import hash_key, packed, unpacked
from siltstone.operators.vault import load_plain_satellite
from siltstone.plans.checks import check_state
from siltstone.schemas import VAULT, reset
from siltstone.session import tune
from siltstone.sources.retail import RetailSource

MD5 = "0CC175B9C0F1B6A831C399E269772661"
T1, T2 = dt.datetime(2002, 1, 1), dt.datetime(2002, 2, 1)


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n in names:
        spark.conf.unset(n)


def test_packed_keys_are_equal_where_keys_are(spark):
    keys = [None, "", MD5, MD5.lower(), MD5[1:], "F", "0F", "x" * 15, "x" * 16, "x" * 32, "ü" * 16, MD5 + "0"]
    rows = spark.createDataFrame([(k,) for k in keys], "k string").select("k", packed(F.col("k")).alias("p")).select("k", "p", unpacked(F.col("p")).alias("u")).collect()
    assert [r.u for r in rows] == keys
    assert len({bytes(r.p) for r in rows if r.p is not None}) == len(keys) - 1
    assert {len(r.p) for r in rows if r.k == MD5} == {16}


def test_satellite_is_dealt_once_by_a_load(spark, no_broadcast):
    schema = "hub_rental_hash_key string, load_date timestamp_ntz, record_source string, load_end_date timestamp_ntz, return_date timestamp_ntz"
    known = spark.createDataFrame([(k, T1, "s", None, T1) for k in ("A", "B", MD5, MD5)], schema).select("*")
    staged = spark.createDataFrame([("B", T2, "s", T2), (MD5, T2, "s", T1), ("C", T2, "s", None)],
                                   "hub_rental_hash_key string, load_date timestamp_ntz, record_source string, return_date timestamp_ntz")
    loaded = load_plain_satellite(known, staged, "hub_rental_hash_key", ["return_date"], "2002-02-01 00:00:00", False, known)
    plan = loaded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 2, plan
    found = sorted((r.hub_rental_hash_key, r.load_date, r.load_end_date) for r in loaded.collect() if r.hub_rental_hash_key != MD5 and r.load_end_date)
    assert found == [("B", T1, T2)]
    assert sorted(r.hub_rental_hash_key for r in loaded.filter("load_end_date IS NULL AND load_date = TIMESTAMP_NTZ '2002-02-01 00:00:00'").collect()) == ["B", "C"]


def test_a_key_with_several_references_is_checked_once(spark):
    state = reset(spark, VAULT)
    hub = spark.createDataFrame([("A",), ("A",), ("B",)], "id string").select(
        hash_key("id").alias("hub_rental_hash_key"), F.lit(T1).cast("timestamp_ntz").alias("load_date"), F.lit("s").alias("record_source"), F.lit(1).cast("bigint").alias("rental_id"))
    state["edw.hub_rental"] = hub
    state["edw.sat_rental_dynamic"] = spark.createDataFrame([("A",), ("C",), ("C",)], "id string").select(
        hash_key("id").alias("hub_rental_hash_key"), F.lit(T1).cast("timestamp_ntz").alias("load_date"), F.lit("s").alias("record_source"),
        F.lit(None).cast("timestamp_ntz").alias("load_end_date"), F.lit(None).cast("timestamp_ntz").alias("return_date"))
    report = check_state(state, VAULT, ["edw"])
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "unhex" in plan  # keys are shuffled packed
    found = {(r.table, r.check, r.subject): r.violations for r in report.collect()}
    assert found["edw.hub_rental", "unique", "hub_rental_hash_key"] == 1
    assert found["edw.sat_rental_dynamic", "reference", "hub_rental_hash_key"] == 2
    assert found["edw.sat_rental_dynamic", "unique", "hub_rental_hash_key,load_date"] == 1
    assert found["edw.sat_rental_static", "reference", "hub_rental_hash_key"] == 0


def test_both_facts_are_stored_by_one_join(spark, tmp_path):
    stamp = "timestamp_ntz"
    spark.createDataFrame([(1, 7, 10.5, T1), (2, 8, 11.0, T1), (None, 9, 12.0, T1)], f"o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate {stamp}").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, 3, 4, T1), (1, 5, 2, T2), (3, 1, 1, T1)], f"l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_shipdate {stamp}").write.parquet(f"{tmp_path}/lineitem.parquet")
    plain, stored = RetailSource(spark, str(tmp_path)), RetailSource(spark, str(tmp_path)).with_stored_facts("payment", "rental")
    key = lambda r: str(r)
    for name in ("payment_base", "rental_base"):
        assert sorted(getattr(stored, name)().collect(), key=key) == sorted(getattr(plain, name)().collect(), key=key)
    assert set(stored.payment_base().inputFiles()) == set(stored.rental_base().inputFiles())


def test_tasks_are_dealt_16_mb_unless_told_otherwise(spark):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if spark.sparkContext.getConf().get(name) is None or spark.sparkContext.getConf().get(name) == "16m":
        assert tune(spark).conf.get(name) == "16m"
