"""One key with a third of the rows: results stay whole and adaptive execution splits it."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from millrace.operators.scd import asof_join, scd2_initial
from millrace.plans import facts

# Thresholds scaled down so that a test-sized key counts as hot.
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
}


@contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def final_plan(df):
    df._jdf.queryExecution().toRdd().count()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.fixture(scope="module")
def hot(spark):
    n = 60_000
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 5000).cast("string"))
    return spark.range(0, n, 1, 8).select(
        F.col("id").cast("string").alias("order_id"),
        key.alias("customer_id"),
        F.expr("timestamp_ntz'2018-01-01' + make_dt_interval(cast(id % 300 AS int))").alias("at"),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"),
    )


def test_asof_join_splits_a_hot_key(spark, hot):
    with settings(spark, SMALL):
        customers = spark.range(5000).select(F.col("id").cast("string").alias("customer_id"))
        customers = customers.unionAll(spark.createDataFrame([("hot",)], "customer_id string"))
        dimension = scd2_initial(customers, "customer_id", "customer_key")
        joined = asof_join(hot, dimension, {"customer_id": "customer_id"}, "at", ["customer_key"])
        assert "skew=true" in final_plan(joined)
        assert joined.count() == 60_000 and joined.where("customer_key IS NULL").isEmpty()


def test_lines_of_a_hot_order_are_aggregated_before_the_shuffle(spark, rows):
    items = spark.range(0, 30_000, 1, 8).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id % 1000 AS string)) AS order_id",
        "cast(id AS int) AS order_item_id",
        "cast(id % 4 AS string) AS product_id",
        "cast(id % 2 AS string) AS seller_id",
        "cast(id % 100 AS decimal(12,2)) AS price",
        "cast(1 AS decimal(12,2)) AS freight_value",
    )
    wanted = {}
    for r in items.collect():
        key = (r.order_id, r.product_id, r.seller_id)
        best, n = wanted.get(key, ((r.order_item_id, r.price), 0))
        wanted[key] = (min(best, (r.order_item_id, r.price)), n + 1)
    got = {(r.order_id, r.product_id, r.seller_id): (r.sale_price, r.quantity, r.freight_value)
           for r in facts.order_lines(items).collect()}
    assert got == {k: (best[1], n, n) for k, (best, n) in wanted.items()}
    plan = facts.order_lines(items)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan[plan.index("Exchange"):] and "SortAggregate" not in plan
