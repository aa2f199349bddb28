"""Numbers and running sums over ranges, against plain ones."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.ranks import numbered, running_sums


@pytest.fixture
def keyed(spark):
    make = random.Random(3)
    keys = [make.choice([None, "", "a", "b", "Z", "é", "日本", "zz"]) for _ in range(500)] + ["hot"] * 400
    return [(k, i, i % 7 - 2) for i, k in enumerate(keys)]


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, (r[0] or "").encode(), r[1]))


def test_numbers_follow_the_order(spark, keyed):
    df = spark.createDataFrame(keyed, "k string, i int, v int").repartition(5)
    out = numbered(df, [F.col("k").isNull(), "k", "i"])
    assert out.columns == ["k", "i", "v", "position"]
    got = sorted(out.collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(len(keyed)))
    assert [tuple(r)[:3] for r in got] == in_order(keyed)


def test_running_sums_leave_out_the_row_itself(spark, keyed):
    df = spark.createDataFrame(keyed, "k string, i int, v int").repartition(5)
    got = {r.i: r.v_before for r in running_sums(df, [F.col("k").isNull(), "k", "i"], ["v"]).collect()}
    total = 0
    for _, i, v in in_order(keyed):
        assert got[i] == total
        total += v


def test_empty(spark):
    none = spark.createDataFrame([], "k string, v long")
    assert numbered(none, ["k"]).count() == 0
    assert running_sums(none, ["k"], ["v"]).count() == 0


def test_only_sizes_of_ranges_meet_in_one_task(spark, plan_of):
    plan = plan_of(numbered(spark.range(10_000), ["id"])).splitlines()
    (at,) = [k for k, line in enumerate(plan) if "SinglePartition" in line]
    assert "HashAggregate" in plan[at + 1]
