"""fact_sales: the lines' two shuffles, and the cases that its order of joins must not change."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions.columns import packed_key, unpacked_key
from millrace.operators import scd
from millrace.plans import facts
from tests.test_skew import final_plan, settings

WIDE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "4",
}
DAY = datetime(2020, 1, 10)


@pytest.fixture
def tables(spark):
    orders = spark.createDataFrame(
        [("1", "c", "canceled", DAY, None, DAY), ("2", "c", "created", DAY, DAY, DAY), ("2", "c", "created", DAY, DAY, DAY), ("3", None, None, None, None, None)],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
        "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz",
    )
    lines = [("1", 1, "p", "s", 5), ("1", 2, "p", "s", 3), ("1", 3, None, "s", 7), ("2", 1, "q", None, 1), ("3", 1, "p", "s", 9), ("4", 1, "p", "s", 9)]
    items = spark.createDataFrame(lines, "order_id string, order_item_id int, product_id string, seller_id string, price int")
    items = items.withColumn("price", F.col("price").cast("decimal(12,2)")).withColumn("freight_value", F.lit(1).cast("decimal(12,2)"))

    def dim(key, *versions):
        ddl = f"{key}_id string, {key}_key string, effective_date timestamp_ntz, expiry_date timestamp_ntz, is_current int"
        return spark.createDataFrame([(*v, 1) for v in versions], ddl)

    old, mid = datetime(1900, 1, 1), datetime(2020, 1, 10)
    customer = dim("customer", ("c", "ab" * 16, old, None))
    seller = dim("seller", ("s", "plain", old, None))
    product = dim("product", ("p", "P" * 32, old, mid), ("p", "0f" * 16, mid, None), ("q", "early", old, datetime(2019, 1, 1)), (None, "none", old, None))
    return orders, items, customer, seller, product


def wanted():
    key, p = "ab" * 16, "0f" * 16
    return sorted(
        [("1", "p", "s", key, p, "plain", 5, 2), ("1", None, "s", key, None, "plain", 7, 1), ("3", "p", "s", None, None, None, 9, 1)]
        + 2 * [("2", "q", None, key, None, None, 1, 1)],
        key=str,
    )


@pytest.mark.parametrize("most", [scd.MOST_LISTED, 1])
def test_versions_nulls_and_repeated_orders(spark, tables, most, monkeypatch):
    """By lists of versions, and, where a product has too many for that, by a join afterwards."""
    monkeypatch.setattr(scd, "MOST_LISTED", most)
    rows = facts.sales_lines(*tables).collect()
    got = [(r.order_id, r.product_id, r.seller_id, r.customer_key, r.product_key, r.seller_key, int(r.sale_price), r.quantity) for r in rows]
    assert sorted(got, key=str) == wanted()
    assert {(r.order_id, r.is_canceled) for r in rows} == {("1", 1), ("2", 0), ("3", 0)}


def test_lines_are_shuffled_twice(spark, tables):
    """Once by product and once by order; none by order, product and seller."""
    with settings(spark, WIDE):
        orders, items, customer, seller, product = tables
        plan = final_plan(facts.sales_lines(orders, items, customer, seller, product))
    assert "hashpartitioning(order_id" in plan and "hashpartitioning(order_id#" in plan
    exchanges = [row for row in plan.splitlines() if "Exchange hashpartitioning(" in row]
    grouped = [row for row in exchanges if "order_id" in row and "product_id" in row]
    assert exchanges and not grouped


def test_packed_keys_come_back(spark):
    keys = ["0f" * 16, "0F" * 16, "", "short", "zz" * 16, "ab" * 8, "ü" * 8, None]
    df = spark.createDataFrame([(k,) for k in keys], "k string").select("k", packed_key("k").alias("p"))
    rows = df.select("k", "p", unpacked_key("p").alias("again")).collect()
    assert all(r.k == r.again for r in rows) and len({r.p for r in rows}) == len(keys)
    assert {len(r.p) for r in rows if r.k == "0f" * 16} == {17}


def test_few_counted_versions_are_broadcast(spark, tables):
    """A dimension that is wide in files and has few versions leaves the facts where they are."""
    orders, _, customer, _, _ = tables
    with settings(spark, {**WIDE, "spark.sql.autoBroadcastJoinThreshold": "1"}):
        joined = scd.asof_join(orders, customer, {"customer_id": "customer_id"}, "order_purchase_timestamp", ["customer_key"], plan="auto")
        assert "BroadcastHashJoin" in final_plan(joined) and joined.count() == 4
