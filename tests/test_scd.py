from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import pytest
from pyspark.sql import functions as F

from millrace.operators import scd
from millrace.operators.scd import scd2_apply, scd2_initial

KEY = ("id", "id_key", ["a"])
DDL = "id string, a string, other int"


def load(spark, batches):
    dimension = None
    for n, batch in enumerate(batches):
        rows = spark.createDataFrame([(k, v, n) for k, v in batch.items()], DDL)
        if dimension is None:
            dimension = scd.scd2_initial(rows, *KEY[:2])
        else:
            dimension = scd.scd2_apply(dimension, rows, *KEY, f"20{n:02d}-01-01 00:00:00")
    return dimension


def test_cases_of_a_second_load(spark, rows):
    first = {"same": "x", "changed": "x", "lost": "x", "gained": None, "absent": "x", "none": None}
    second = {"same": "x", "changed": "y", "lost": None, "gained": "x", "new": "z", "none": None}
    got = rows(load(spark, [first, second]), "id", "a", "is_current", "effective_date", "expiry_date")
    old, now = datetime(1900, 1, 1), datetime(2001, 1, 1)
    assert got == sorted(
        [
            ("same", "x", 1, old, None),
            ("none", None, 1, old, None),
            ("absent", "x", 1, old, None),
            ("changed", "x", 0, old, now),
            ("changed", "y", 1, now, None),
            ("lost", "x", 0, old, now),
            ("lost", None, 1, now, None),
            ("gained", None, 0, old, now),
            ("gained", "x", 1, now, None),
            ("new", "z", 1, now, None),
        ],
        key=repr,
    )


def test_untracked_change_keeps_the_version(spark, rows):
    dimension = load(spark, [{"k": "x"}, {"k": "x"}])
    assert rows(dimension, "id", "other") == [("k", 0)]


def test_changed_and_staged(spark, rows):
    held = load(spark, [{"k": "x", "s": "x"}])
    batch = spark.createDataFrame([("k", "y", 1), ("s", "x", 1), ("n", "x", 1)], DDL)
    assert rows(scd.scd2_changed(held, batch, "id", ["a"]), "id") == [("k",)]
    assert rows(scd.scd2_staged(held, batch, "id", ["a"]), "merge_key", "id") == [
        ("k", "k"), ("n", "n"), ("s", "s"), (None, "k"),
    ]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.dictionaries(st.sampled_from("pqrs"), st.sampled_from("xy") | st.none(), min_size=1),
        min_size=2,
        max_size=4,
    )
)
def test_intervals_are_gapless_and_one_version_is_open(spark, batches):
    dimension = load(spark, batches)
    versions: dict[str, list] = {}
    for r in dimension.collect():
        versions.setdefault(r.id, []).append(r)
    last = {}
    for batch in batches:
        last |= batch
    assert set(versions) == set(last)
    for key, found in versions.items():
        found.sort(key=lambda r: r.effective_date)
        assert [r.is_current for r in found] == [0] * (len(found) - 1) + [1]
        assert found[-1].expiry_date is None and found[-1].a == last[key]
        for early, late in zip(found, found[1:]):
            assert early.expiry_date == late.effective_date
    assert len({r.id_key for rs in versions.values() for r in rs}) == sum(map(len, versions.values()))


def test_asof_join_boundaries(spark, rows, plan_of):
    dimension = load(spark, [{"k": "x"}, {"k": "y"}])
    facts = spark.createDataFrame(
        [
            (1, "k", datetime(2000, 12, 31)),
            (2, "k", datetime(2001, 1, 1)),
            (3, "k", datetime(2005, 1, 1)),
            (4, "nobody", datetime(2005, 1, 1)),
            (5, None, datetime(2005, 1, 1)),
            (6, "k", None),
        ],
        "n int, fk string, at timestamp_ntz",
    )
    joined = scd.asof_join(facts, dimension, {"fk": "id"}, "at", ["a"])
    assert rows(joined, "n", "a") == [(1, "x"), (2, "y"), (3, "y"), (4, None), (5, None), (6, None)]
    assert joined.columns == ["n", "fk", "at", "a"]


def test_asof_join_is_an_equi_join(spark, plan_of):
    dimension = load(spark, [{"k": "x"}])
    facts = spark.range(10).selectExpr("cast(id AS string) AS fk", "timestamp_ntz'2001-01-01' AS at")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(scd.asof_join(facts, dimension, {"fk": "id"}, "at", ["a"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_repeated_clock_replaces_the_version(spark):
    names = "k string, city string"
    held = scd2_initial(spark.createDataFrame([("a", "x")], names), "k", "sk")
    for city in ("y", "z"):
        batch = spark.createDataFrame([("a", city)], names)
        held = scd2_apply(held, batch, "k", "sk", ["city"], "2024-01-01 00:00:00")
    got = held.orderBy("effective_date").collect()
    assert [(r.city, r.is_current) for r in got] == [("x", 0), ("z", 1)]
    assert len({r.sk for r in got}) == 2
    older = scd2_apply(held, spark.createDataFrame([("a", "w")], names), "k", "sk", ["city"], "2023-01-01 00:00:00")
    with pytest.raises(Exception, match="after the load's clock"):
        older.collect()


@pytest.fixture(scope="module")
def many_versions(spark):
    """500 versions a key with gaps between some; facts before, between, at and after them."""
    start = "timestamp_ntz'2000-01-01'"
    versions = spark.range(3 * 500).selectExpr(
        "concat('k', id % 3) AS id", "id AS a", f"{start} + make_interval(0, 0, 0, cast(id div 3 AS int) * 3) AS effective_date"
    )
    versions = versions.withColumn(
        "expiry_date", F.expr("CASE WHEN a >= 1497 THEN NULL ELSE effective_date + make_interval(0, 0, 0, 2 + cast(a % 2 AS int)) END")
    )
    facts = spark.range(4000).selectExpr(
        "id AS n",
        "CASE WHEN id % 50 = 0 THEN NULL WHEN id % 7 = 0 THEN 'nobody' WHEN id % 3 = 0 THEN 'k1' ELSE 'k0' END AS fk",
        f"CASE WHEN id % 41 = 0 THEN NULL WHEN id % 5 = 0 THEN {start} + INTERVAL 600 DAYS"
        f" ELSE {start} + make_interval(0, 0, 0, cast(id % 1600 AS int) - 40) END AS at",
    )
    return facts.cache(), versions.cache()


@pytest.mark.parametrize("hot_rows", [scd.HOT_ROWS, 2000, 60, 7])
def test_carried_versions_equal_looked_up_ones(rows, many_versions, hot_rows):
    """Whole keys, split keys, and moments that fill several time ranges."""
    facts, versions = many_versions
    on, take = {"fk": "id"}, ["a"]
    want = scd.asof_join(facts, versions, on, "at", take)
    got = scd.asof_join(facts, versions, on, "at", take, plan="carry", hot_rows=hot_rows)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert rows(got) == rows(want) and len(rows(got)) == 4000


def test_carrying_makes_no_rows_beyond_facts_and_versions(many_versions, plan_of):
    facts, versions = many_versions
    plan = plan_of(scd.asof_join(facts, versions, {"fk": "id"}, "at", ["a"], plan="carry"))
    assert "Join" not in plan and plan.count("Window") == 1


def test_plan_follows_the_number_of_versions(spark, many_versions, plan_of):
    facts, versions = many_versions
    first = versions.where("a < 3")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [plan_of(scd.asof_join(facts, v, {"fk": "id"}, "at", ["a"], plan="auto")) for v in (versions, first)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Window" in plans[0] and "SortMergeJoin" in plans[1]


def test_carried_over_several_keys_and_no_versions(spark, rows):
    facts = spark.createDataFrame([(1, "a", 1, datetime(2001, 1, 2)), (2, "a", 2, datetime(2001, 1, 2))], "n int, x string, y int, at timestamp_ntz")
    versions = spark.createDataFrame([("a", 1, datetime(2001, 1, 2), None, "v")], "p string, q int, effective_date timestamp_ntz, expiry_date timestamp_ntz, w string")
    on = {"x": "p", "y": "q"}
    assert rows(scd.asof_join(facts, versions, on, "at", ["w"], plan="carry"), "n", "w") == [(1, "v"), (2, None)]
    assert rows(scd.asof_join(facts, versions.limit(0), on, "at", ["w"], plan="carry"), "n", "w") == [(1, None), (2, None)]
    assert scd.asof_join(facts.limit(0), versions, on, "at", ["w"], plan="carry").count() == 0
    with pytest.raises(ValueError):
        scd.asof_join(facts, versions, on, "at", ["w"], plan="other")
