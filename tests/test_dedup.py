import pytest
from pyspark.sql import functions as F

from millrace.operators.dedup import first_per_key, latest_per_key


def test_latest_row_wins_and_ties_are_settled(spark, rows):
    data = [(1, 10, "a"), (1, 20, "b"), (1, 20, "c"), (2, None, "d"), (2, 5, "e"), (None, 1, "f"), (None, 2, "g")]
    df = spark.createDataFrame(data, "k int, w int, v string")
    wanted = sorted([(1, 20, "c"), (2, 5, "e"), (None, 2, "g")], key=repr)
    for parts in (1, 3, 7):
        assert rows(latest_per_key(df.repartition(parts), ["k"], ["w"])) == wanted


def test_composite_key(spark, rows):
    df = spark.createDataFrame([("o", 1, 1), ("o", 2, 1), ("o", 1, 2)], "o string, i int, w int")
    assert rows(latest_per_key(df, ["o", "i"], ["w"])) == [("o", 1, 2), ("o", 2, 1)]


def test_first_per_key_keeps_one_row_whole(spark, rows):
    df = spark.createDataFrame([("z", 2.0, "p"), ("z", 1.0, "q")], "k string, lat double, city string")
    assert rows(first_per_key(df, ["k"], [F.col("lat")])) == [("z", 1.0, "q")]


def test_rows_of_a_hot_key_are_cut_before_the_shuffle(spark, plan_of):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("w"))
    plan = plan_of(latest_per_key(df, ["k"], ["w"]))
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


@pytest.mark.parametrize("share", [3, 2])
def test_hot_key_against_brute_force(spark, rows, share):
    n = 6000
    df = spark.range(n).select(
        F.when(F.col("id") % share == 0, F.lit(-1)).otherwise(F.col("id") % 97).alias("k"),
        ((F.col("id") * 7919) % 1009).alias("w"),
        F.col("id").alias("v"),
    )
    best = {}
    for r in df.collect():
        if r.k not in best or (r.w, r.v) > best[r.k]:
            best[r.k] = (r.w, r.v)
    assert rows(latest_per_key(df, ["k"], ["w"])) == sorted(
        ((k, *wv) for k, wv in best.items()), key=repr
    )
