"""Operators on hand-made cases and against brute force in plain Python."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from siltstone import functions as fn
from siltstone import operators as op
from siltstone.operators.filters import known_filter
from siltstone.schemas import CORPORATE, STAR, VAULT, empty, reset
from siltstone.sources import RetailSource, align_columns

DAY0 = datetime(2001, 1, 1)


def rows(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_marks_and_journal(spark):
    journal = empty(spark, STAR, "staging.last_update_data")
    assert op.high_water_mark(journal, "t") == "1900-01-01 00:00:00"
    assert op.previous_load_time(journal, "t") is None
    journal = op.record_load(journal, "t", "2002-01-01 00:00:00")
    assert op.previous_load_time(journal, "t") is None
    journal = op.record_load(op.record_load(journal, "t", "2002-02-01 00:00:00"), "u", "2003-01-01 00:00:00")
    assert op.high_water_mark(journal, "t") == "2002-02-01 00:00:00"
    assert op.previous_load_time(journal, "t") == "2002-01-01 00:00:00"
    # the same time twice: the one before the last row is that time
    journal = op.record_load(journal, "t", "2002-02-01 00:00:00")
    assert op.previous_load_time(journal, "t") == "2002-02-01 00:00:00"


def test_incremental_takes_the_mark_itself_and_untouched_deletes(spark):
    schema = "id int, last_update timestamp_ntz, deleted timestamp_ntz"
    src = rows(spark, [(1, DAY0, None), (2, DAY0 + timedelta(1), None), (3, DAY0, DAY0 + timedelta(2)), (4, DAY0, DAY0)], schema)
    got = op.extract_incremental(src, ["id"], "2001-01-02 00:00:00")
    assert sorted(r.id for r in got.collect()) == [2, 3]


def test_upsert_since_options(spark):
    schema = "id int, v string, last_update timestamp_ntz, deleted timestamp_ntz"
    target = rows(spark, [(1, "a", DAY0, None), (2, "b", DAY0, None)], schema)
    source = rows(spark, [(1, "A", DAY0, DAY0 + timedelta(5)), (2, "B", DAY0, None), (3, "C", DAY0 + timedelta(1), None)], schema)
    values = lambda df: sorted(r.v for r in df.collect())
    assert values(op.upsert_since(target, source, "id")) == ["C", "a", "b"]
    assert values(op.upsert_since(target, source, "id", deleted="deleted")) == ["A", "C", "b"]
    assert values(op.upsert_since(target, source, "id", inclusive=True)) == ["A", "B", "C"]
    assert values(op.upsert_since(target.filter("id < 0"), source, "id")) == ["A", "B", "C"]


def test_mark_is_observed_while_writing(spark):
    schema = "id int, v string, last_update timestamp_ntz, deleted timestamp_ntz"
    rows_in = rows(spark, [(1, "a", DAY0, None), (2, "b", DAY0 + timedelta(1, 3, 7), None)], schema)
    target, mark = op.stored_with_mark(rows_in, "t")
    source = rows(spark, [(2, "B", DAY0 + timedelta(1, 3, 7), None), (3, "C", DAY0 + timedelta(1, 3, 8), None)], schema)
    assert sorted(r.v for r in op.upsert_since(target, source, "id", mark=mark).collect()) == ["C", "a", "b"]
    assert sorted(r.v for r in op.upsert_since(target, source, "id", mark=mark, inclusive=True).collect()) == ["B", "C", "a"]
    empty_target, mark = op.stored_with_mark(rows_in.limit(0), "t")
    assert op.upsert_since(empty_target, source, "id", mark=mark).count() == 2


def test_filter_knows_every_key(spark):
    keys = spark.range(0, 3000, 3).select((F.col("id") * 1_000_003).alias("k"))
    keys = keys.unionByName(spark.range(1).select(F.lit(None).cast("bigint").alias("k")))
    other = spark.range(-3000, 6000).select((F.col("id") * 1_000_003).alias("k"))
    passed = {r.k for r in other.filter(known_filter(keys, "k")).collect()}
    assert {r.k for r in keys.collect() if r.k is not None} <= passed and len(passed) < 1100
    assert other.filter(known_filter(keys.limit(0), "k")).isEmpty()
    words = rows(spark, [("a",), ("b",), (None,)], "k string")
    assert [r.k for r in words.filter(known_filter(words.filter("k = 'b'"), "k")).collect()] == ["b"]


def test_missing_parents(spark):
    child = rows(spark, [(1, 10, 5), (2, 11, None), (3, None, 6), (3, None, 6)], "id int, a bigint, b bigint")
    a, b = rows(spark, [(10,), (10,), (None,)], "x bigint"), rows(spark, [(5,)], "y int")
    found = op.missing_parents(child, "id", {"a": (a, "x"), "b": (b, "y")})
    assert sorted(map(tuple, found.collect())) == [(2, "a", 11), (3, "b", 6), (3, "b", 6)]


def test_changes_do_not_depend_on_partitions(spark, folder):
    source = RetailSource(spark, folder, 1)
    make = lambda n, seed=3, **kw: sorted(map(str, op.synthetic_changes(
        source.rental_base().repartition(n), source.inventory_base(), source("customer"), source.raw("supplier"), "2002-02-01 00:00:00", seed, **kw).collect()))
    one = make(1)
    assert one == make(16) != make(1, 4)
    feed = op.synthetic_changes(source.rental_base(), source.inventory_base(), source("customer"), source.raw("supplier"), "2002-02-01 00:00:00", 3,
                                shares={"late": 0.3, "delete": 0.2, "insert": 0.2, "repeat": 0.3})
    top, n = source.rental_base().agg(F.max("rental_id")).first()[0], source.rental_base().count()
    by = {c: feed.filter(F.col("change") == c) for c in ("late", "delete", "insert", "repeat")}
    assert by["late"].filter("last_update >= TIMESTAMP_NTZ '2002-01-31 00:00:00' OR deleted IS NOT NULL").isEmpty()
    assert by["delete"].filter("deleted IS NULL OR deleted <> last_update").isEmpty() and by["insert"].filter(f"rental_id <= {top} OR return_date IS NOT NULL").isEmpty()
    assert by["repeat"].groupBy("rental_id").count().filter("count <> 2").isEmpty()
    assert sum(df.select("rental_id").distinct().count() for df in by.values()) == n and 0.15 * n < by["insert"].count() < 0.25 * n


def test_dense_keys_in_order_over_many_partitions(spark):
    registry = rows(spark, [(1, 50), (2, 7)], "sk bigint, nk bigint")
    keys = spark.range(0, 5000).select((F.col("id") * 3).alias("nk")).repartition(16)
    synced = op.sync_keys(registry, keys.union(keys.limit(10)), "sk", "nk")
    got = {r.nk: r.sk for r in synced.collect()}
    fresh = sorted(n * 3 for n in range(5000) if n * 3 not in (50, 7))
    assert got == {50: 1, 7: 2} | {n: i for i, n in enumerate(fresh, 3)}
    assert op.sync_keys(synced, keys, "sk", "nk").count() == synced.count()


def test_replace_keys_drops_unknown(spark):
    known = op.Registry(rows(spark, [(1, 10), (2, 20)], "sk bigint, nk bigint"), "sk", "nk")
    df = rows(spark, [(10, 20, "x"), (20, 99, "y")], "a bigint, b bigint, c string")
    assert [tuple(r) for r in op.replace_keys(df, {"a": known, "b": known}).collect()] == [(1, 2, "x")]


def test_fill_keys_are_unique_and_above(spark):
    known = rows(spark, [(5, "a"), (9, "b")], "pk bigint, v string")
    new = spark.range(100).select(F.lit(None).cast("bigint").alias("pk"), F.col("id").cast("string").alias("v")).repartition(7)
    from siltstone import materialize
    got = [r.pk for r in materialize(op.fill_keys(known.union(new), "pk", known)).collect()]
    assert len(set(got)) == 102 and {5, 9} <= set(got) and min(p for p in got if p not in (5, 9)) > 9


def test_hashes(spark):
    df = rows(spark, [(" Abc ", None, 1), ("abc", "", 1), ("abd", "", 1)], "a string, b string, c int")
    keys = [r[0] for r in df.select(fn.hash_key("a", "b", "c")).collect()]
    assert keys[0] == keys[1] != keys[2] and all(len(k) == 32 and k == k.upper() for k in keys)
    whole = [r[0] for r in df.select(fn.row_hash(df.columns)).collect()]
    assert len(set(whole)) == 3
    assert df.select(fn.hash_key("c")).first()[0] == "C4CA4238A0B923820DCC509A6F75849B"


def test_scd2_steps_equal_the_merge(spark, folder):
    from siltstone.plans import catalog, star
    before, staged = catalog._dims_before(spark, folder)
    dim, delta = catalog._shown(before["core.dim_inventory"]), staged["staging.inventory"]
    lookup = star.describe_disc(staged["staging.film"])
    ended = op.scd2_soft_delete(dim, delta, "inventory_id")
    seen = dim.select("inventory_id").distinct()
    steps = op.scd2_version(op.scd2_insert_new(ended, delta, "inventory_id", lookup), delta, "inventory_id", lookup, seen=seen)
    merged = op.scd2_merge(dim, delta, "inventory_id", lookup)
    assert sorted(map(str, steps.collect())) == sorted(map(str, merged.collect()))


def test_scd2_compare_skips_touched_rows(spark):
    dim = rows(spark, [(1, "a", datetime(1900, 1, 1), datetime(2199, 1, 1), True),
                       (2, "b", datetime(1900, 1, 1), datetime(2199, 1, 1), True)],
               "id int, v string, effective_date_from timestamp_ntz, effective_date_to timestamp_ntz, is_active boolean")
    staged = rows(spark, [(1, "a", DAY0, None), (2, "B", DAY0, None), (3, "c", DAY0, None)],
                  "id int, v string, last_update timestamp_ntz, deleted timestamp_ntz")
    assert op.scd2_merge(dim, staged, "id").count() == 5
    assert sorted(r.v for r in op.scd2_merge(dim, staged, "id", compare=["v"]).collect()) == ["B", "a", "b", "c"]


def test_scd2_reopens_after_soft_delete(spark):
    span = "effective_date_from timestamp_ntz, effective_date_to timestamp_ntz, is_active boolean"
    dim = rows(spark, [(1, DAY0, DAY0 + timedelta(3), False)], f"id int, {span}")
    staged = rows(spark, [(1, DAY0 + timedelta(9), None)], "id int, last_update timestamp_ntz, deleted timestamp_ntz")
    got = op.scd2_merge(dim, staged, "id").orderBy("effective_date_from").collect()
    assert [r.is_active for r in got] == [False, True] and got[0].effective_date_to == DAY0 + timedelta(3)


def test_zero_length_version_at_the_mark(spark):
    """A row stamped exactly at the start of its live version leaves a version without length."""
    span = "effective_date_from timestamp_ntz, effective_date_to timestamp_ntz, is_active boolean"
    dim = rows(spark, [(1, DAY0, datetime(2199, 1, 1), True)], f"id int, {span}")
    staged = rows(spark, [(1, DAY0, None)], "id int, last_update timestamp_ntz, deleted timestamp_ntz")
    got = sorted((r.effective_date_from, r.effective_date_to, r.is_active) for r in op.scd2_merge(dim, staged, "id").collect())
    assert got == [(DAY0, DAY0, False), (DAY0, datetime(2199, 1, 1), True)]


@pytest.mark.parametrize("closed", ["both", "left"])
def test_as_of_join_against_brute_force(spark, closed):
    rng = random.Random(5)
    versions, facts = [], []
    for key in range(20):
        at = 0
        for _ in range(200 if key == 0 else 4):  # key 0 has most versions
            step = rng.randint(0, 3)
            versions.append((key, DAY0 + timedelta(at), DAY0 + timedelta(at + step), f"{key}/{len(versions)}"))
            at += step
    for i in range(1500):
        key = 0 if i % 3 else rng.randint(0, 22)  # two thirds of the facts carry key 0
        facts.append((i, key, DAY0 + timedelta(rng.randint(-5, 320))))
    dim = rows(spark, versions, "k int, effective_date_from timestamp_ntz, effective_date_to timestamp_ntz, v string")
    df = rows(spark, facts, "id int, k int, at timestamp_ntz")
    inside = lambda t, v: v[1] <= t and (t <= v[2] if closed == "both" else t < v[2])
    want = sorted((f[0], v[3]) for f in facts for v in versions if v[0] == f[1] and inside(f[2], v))
    got = op.as_of_join(df, dim, "k", "at", {"v": "v"}, closed)
    assert got.columns == ["id", "k", "at", "v"]
    assert sorted((r.id, r.v) for r in got.collect()) == want


@pytest.mark.parametrize("closed", ["both", "left"])
def test_as_of_join_and_misses_with_any_intervals(spark, closed):
    """Versions with gaps, without length, with equal starts, repeated, nested and ending before they start; facts without key or time."""
    rng = random.Random(11)
    versions = [(k, DAY0 + timedelta(a), DAY0 + timedelta(a + rng.randint(-1, 6)), n % 7) for n, (k, a) in
                enumerate((rng.randint(0, 8), rng.randint(0, 40)) for _ in range(120))]
    versions += versions[:5] + [(None, DAY0, DAY0 + timedelta(50), 1)]
    facts = [(i, rng.choice([None, *range(11)]), None if i % 50 == 0 else DAY0 + timedelta(rng.randint(-3, 50))) for i in range(600)]
    dim = rows(spark, versions, "k int, effective_date_from timestamp_ntz, effective_date_to timestamp_ntz, v int").repartition(5)
    df = rows(spark, facts + facts[:30], "id int, k int, at timestamp_ntz").repartition(3)
    inside = lambda t, v: v[1] <= t and (t <= v[2] if closed == "both" else t < v[2])
    meets = lambda f: [v[3] for v in versions if None not in f and v[0] == f[1] and inside(f[2], v)]
    want = sorted((f[0], v) for f in facts + facts[:30] for v in meets(f))
    assert sorted((r.id, r.v) for r in op.as_of_join(df, dim, "k", "at", {"v": "v"}, closed).collect()) == want

    def reason(f):
        starts = sorted(v[1] for v in versions if v[0] == f[1])
        if None in f:
            return "no key" if f[1] is None else "no time"
        if not starts or f[2] < starts[0]:
            return "before the first version" if starts else "unknown key"
        return "between two versions" if f[2] < starts[-1] else "after the last version"

    missed = [(f[0], reason(f)) for f in facts + facts[:30] if not meets(f)]
    assert sorted((r.id, r.reason) for r in op.as_of_misses(df, dim, "k", "at", closed).collect()) == sorted(missed)
    assert {r for _, r in missed} == {"no key", "no time", "unknown key", "before the first version", "between two versions", "after the last version"}


def test_as_of_join_of_empty_tables(spark):
    dim = rows(spark, [(1, DAY0, DAY0 + timedelta(9), 5)], "k int, effective_date_from timestamp_ntz, effective_date_to timestamp_ntz, v int")
    df = rows(spark, [(1, 1, DAY0), (2, 3, DAY0)], "id int, k int, at timestamp_ntz")
    assert [tuple(r) for r in op.as_of_join(df, dim, "k", "at", {"v": "w"}).collect()] == [(1, 1, DAY0, 5)]
    for a, b in ((df.limit(0), dim), (df, dim.limit(0)), (df.limit(0), dim.limit(0))):
        assert op.as_of_join(a, b, "k", "at", {"v": "v"}).isEmpty() and op.as_of_misses(a, b, "k", "at").count() == a.count()


def test_calendar(spark):
    cal = op.calendar(spark, "2005-01-01", 7305)
    assert len(cal.columns) == 25 and cal.count() == 7305
    last = cal.orderBy(F.desc("date_pk")).first()
    assert str(last.date_actual) == "2024-12-31" and last.day_of_year == 366 and last.month_name == "Декабрь"
    leap = cal.filter("date_pk = 20080229").first()
    assert (leap.day_name, leap.day_of_week, leap.week_of_month, str(leap.last_day_of_month)) == ("Пятница", 5, 5, "2008-02-29")
    assert op.calendar_short(spark, "2005-01-01", 2, "en").orderBy("date_id").first().month_name == "January"


def test_reset_gives_declared_types(spark):
    for tables, n in ((STAR, 18), (CORPORATE, 44), (VAULT, 17)):
        state = reset(spark, tables)
        assert len(state) == len(tables)
        assert all(df.isEmpty() for df in state.values())
    assert dict(reset(spark, STAR, ["mart"])["mart.sales_film"].dtypes) == {"film_title": "string", "amount": "decimal(18,2)"}


def test_align_columns_keeps_what_is_there(spark):
    df = align_columns(spark.range(1), {"id": "bigint", "deleted": "timestamp_ntz"})
    assert df.dtypes == [("id", "bigint"), ("deleted", "timestamp_ntz")]


def test_checks(spark):
    df = rows(spark, [(1, "ab", "G"), (1, None, "X"), (None, "abcd", None)], "k int, t string, r string")
    count = lambda report: {r.subject: r.violations for r in report.collect()}
    assert count(op.check_not_null(df, ["k", "t"])) == {"k": 1, "t": 1}
    assert count(op.check_domain(df, "r", ["G", "PG"])) == {"r": 1}
    assert count(op.check_domain(df, "k", low=1, high=5)) == {"k": 0}
    assert count(op.check_length(df, {"t": 3})) == {"t": 1}
    assert count(op.check_unique(df, ["k"])) == {"k": 1}
    assert count(op.check_reference(df, "k", rows(spark, [(2,)], "k int"), "k")) == {"k": 2}
    assert count(op.check_schema(df, ["k"], {"t": 3})) == {"k not null": 1, "t at most 3": 1}


def test_generator_draws_and_defaults(spark, folder):
    source = RetailSource(spark, folder, 1)
    make = lambda **kw: op.synthetic_rentals(source("rental"), source("inventory"), source("film"), source("customer"),
                                             source("staff"), 500, **kw)
    df = make(seed=3, base=0)
    assert df.count() == 500 and df.select("rental_date").distinct().count() == 1
    assert df.collect() == make(seed=3, base=0).collect() != make(seed=4, base=0).collect()
    assert str(make(day="2003-05-06").first().rental_date) == "2003-05-06 00:00:00"


def test_payment_rewrite_takes_the_last_of_two_border_versions(spark):
    """On the border of two disc versions a payment meets both; the later one is written in place."""
    start, border, end = datetime(1900, 1, 1), datetime(2002, 1, 10), datetime(2199, 1, 1)
    discs = rows(spark, [(1, 7, start, border, False), (2, 7, border, end, True)],
                 "inventory_pk bigint, inventory_id bigint, effective_date_from timestamp_ntz, effective_date_to timestamp_ntz, is_active boolean")
    staff = rows(spark, [(1, 3, start, end, True)],
                 "staff_pk bigint, staff_id bigint, effective_date_from timestamp_ntz, effective_date_to timestamp_ntz, is_active boolean")
    calendar = op.calendar(spark, "2002-01-01", 31)
    fact = empty(spark, STAR, "core.fact_payment")
    staged = rows(spark, [(100, 1, 3, 9, 7, border, border, None)],
                  "payment_id bigint, customer_id bigint, staff_id bigint, rental_id bigint, inventory_id bigint, "
                  "payment_date timestamp_ntz, last_update timestamp_ntz, deleted timestamp_ntz").withColumn(
        "amount", F.lit(5).cast("decimal(12,2)"))
    got = op.load_fact_payment(fact, staged, discs, staff, calendar).collect()
    assert [r.inventory_fk for r in got] == [2, 2]
    assert [r.inventory_fk for r in op.load_fact_payment(fact, staged, discs, staff, calendar, closed="left").collect()] == [2]


def test_feed_applies_each_batch_once(spark, folder, tmp_path):
    from siltstone.streaming import apply_feed
    rows_in = RetailSource(spark, folder, 1)("payment")
    rows_in.repartition(3).write.parquet(str(tmp_path / "in"))
    feed = spark.readStream.schema(rows_in.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    seen = {"batches": 0, "target": empty(spark, CORPORATE, "ods.payment")}

    def load(delta, batch_id):
        from siltstone import materialize
        seen["batches"] += 1
        seen["target"] = materialize(op.upsert(seen["target"], delta, "payment_id"))

    apply_feed(feed, load, str(tmp_path / "checkpoint"))
    apply_feed(feed, load, str(tmp_path / "checkpoint"))
    assert seen["batches"] == 3 and seen["target"].count() == rows_in.count()


class _Reader:
    """Notes the options that a JDBC reader is given, and answers for the bounds."""

    def __init__(self, seen, bounds):
        self.seen, self.bounds, self.given = seen, bounds, {}

    def format(self, kind):
        assert kind == "jdbc"
        return self

    def options(self, **options):
        self.given |= options
        return self

    def load(self):
        self.seen.append(self.given)
        return self

    def first(self):
        return self.bounds


def test_remote_scan_options():
    from types import SimpleNamespace

    from siltstone.sources import jdbc_source
    for bounds, split in (((3, 9000), "payment_id"), ((None, None), "payment_id"), (None, ("payment_id", 3, 9000)), (None, None)):
        seen = []

        class Session:
            sparkContext = SimpleNamespace(defaultParallelism=64)
            read = property(lambda self, seen=seen, bounds=bounds: _Reader(seen, bounds))

        jdbc_source(Session(), "jdbc:x", split={"payment": split} if split else None, user="u")("payment")
        assert all(g["fetchsize"] == "10000" and g["user"] == "u" for g in seen) and seen[-1]["dbtable"] == "public.payment"
        assert (len(seen) == 2) == (split == "payment_id")
        parted = {"partitionColumn": "payment_id", "lowerBound": "3", "upperBound": "9000", "numPartitions": "64"}
        wanted = parted if split and (bounds is None or bounds[0] is not None) else {}
        assert {k: v for k, v in seen[-1].items() if k in parted} == wanted
