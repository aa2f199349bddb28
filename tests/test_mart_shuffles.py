"""Marts and the star join: how often and how wide facts are shuffled, and results they must not change."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from millrace.operators.scd import join_versions
from millrace.plans.marts import build_mart
from tests.test_skew import final_plan, settings

WIDE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "4",
}


def key(n):
    return f"{n:032x}"


@pytest.fixture
def star(spark):
    def line(order, customer, product, seller, price):
        return (order, customer, product, seller, 20200110, price, 1, 1)

    sales = spark.createDataFrame(
        [line("1", key(1), key(1), key(1), 5), line("1", key(1), key(2), key(1), 7), line("2", key(1), key(2), key(1), 9), line("3", None, "plain", key(9), 1)],
        "order_id string, customer_key string, product_key string, seller_key string, purchase_time_key int, sale_price int, quantity int, freight_value int",
    )
    sales = sales.withColumns({c: F.col(c).cast("decimal(12,2)") for c in ("sale_price", "freight_value")})
    sides = {f"dim_{n}": spark.createDataFrame([(key(1), f"city {n}")], f"{n}_key string, city_key string") for n in ("customer", "seller")}
    return sides | {
        "fact_sales": sales,
        "dim_product": spark.createDataFrame([(key(1), "c"), (key(2), "c"), ("plain", "d")], "product_key string, category_key string"),
        "dim_product_category": spark.createDataFrame([("c", "toys")], "category_key string, category_name_en string"),
        "dim_time": spark.createDataFrame([(20200110, date(2020, 1, 10))], "time_key int, full_date date"),
    }


@pytest.mark.parametrize("conf", [{}, WIDE])
def test_revenue_counts_orders_once(spark, star, conf):
    """Two lines of one order in one cell are one order; unknown keys and no key make a cell of nulls."""
    with settings(spark, conf):
        rows = build_mart("revenue_mart", star).collect()
    got = {(r.product_category, r.seller_key, r.customer_geo_key): (r.total_orders, int(r.total_revenue), r.total_items_sold) for r in rows}
    assert got == {("toys", key(1), "city customer"): (2, 24, 3), (None, None, None): (1, 2, 1)}
    assert {r.date for r in rows} == {date(2020, 1, 10)}


def test_revenue_lines_meet_once_for_cells(spark, star):
    """No shuffle by cells and orders beside that by cells."""
    with settings(spark, WIDE):
        plan = final_plan(build_mart("revenue_mart", star))
    exchanges = [row for row in plan.splitlines() if "Exchange hashpartitioning(" in row and "customer_geo_key" in row]
    assert len(exchanges) == 1 and "order_id" not in exchanges[0]


def test_few_versions_leave_facts_where_they_are(spark, star):
    with settings(spark, {**WIDE, "spark.sql.autoBroadcastJoinThreshold": "1"}):
        rows = spark.createDataFrame([(b"\x01" + bytes.fromhex(key(1)),), (None,)], "seller_key binary")
        joined = join_versions(rows, star["dim_seller"], "seller_key", ["city_key"])
        assert "BroadcastHashJoin" in final_plan(joined)
        assert {r.city_key for r in joined.collect()} == {"city seller", None}
