"""Dimensions, facts and marts on small frames."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.plans import dimensions as dims
from millrace.plans import facts, marts
from millrace.operators.scd import scd2_initial


def test_default_calendar(spark):
    calendar = dims.dim_time(spark)
    assert calendar.count() == 8401
    day = calendar.where("time_key = 20180203").first()
    assert tuple(day) == (20180203, date(2018, 2, 3), 3, 2, 1, 2018, "Sat", 1)
    assert calendar.where("is_weekend = 1 AND day_of_week NOT IN ('Sat', 'Sun')").isEmpty()


def test_calendar_is_widened_by_data(spark):
    dates = spark.createDataFrame([(datetime(1999, 5, 1),), (None,)], "d timestamp_ntz")
    bounds = dims.dim_time_covering(dates, "d").agg(F.min("full_date"), F.max("full_date")).first()
    assert tuple(bounds) == (date(1999, 5, 1), date(2030, 12, 31))


def test_geolocation_takes_one_row_whole(spark, rows):
    df = spark.createDataFrame(
        [("00001", 2.0, 1.0, "b", "B"), ("00001", 1.0, 9.0, "a", "A")],
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
        "geolocation_city string, geolocation_state string",
    )
    assert rows(dims.dim_geolocation(df), "zip_code_prefix", "lat", "lng", "city") == [
        ("00001", 1.0, 9.0, "a")
    ]


def money(x):
    return Decimal(x).quantize(Decimal("0.01"))


@pytest.fixture(scope="module")
def star(spark):
    """One hot order holds a third of the reviews and of the lines; some orders lack a side."""
    stamp = datetime(2018, 1, 1)
    n_orders, hot = 12, 20
    order_ids = [f"o{i}" for i in range(n_orders)]
    orders = spark.createDataFrame(
        [
            (o, f"c{i % 3}", "canceled" if i == 3 else "delivered", datetime(2018, 1, 1 + i % 4),
             datetime(2018, 1, 3), datetime(2018, 1, 2 + i) if i % 4 else None, datetime(2018, 1, 6))
            for i, o in enumerate(order_ids)
        ],
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
        "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz",
    )
    lines = [("o0", j, f"p{j % 4}", f"s{j % 5}") for j in range(hot)]
    lines += [(o, j, f"p{j}", f"s{j}") for o in order_ids[1:9] for j in range(1 + len(o))]
    items = spark.createDataFrame(
        [(*row, stamp, money(10 + i), money(1 + i % 3)) for i, row in enumerate(lines)],
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "shipping_limit_date timestamp_ntz, price decimal(12,2), freight_value decimal(12,2)",
    )
    reviewed = ["o0"] * hot + order_ids[2:11] + ["unknown"]
    reviews = spark.createDataFrame(
        [(f"r{i}", o, i % 5 + 1 if i % 9 else None, datetime(2018, 1, 5 + i % 3))
         for i, o in enumerate(reviewed)],
        "review_id string, order_id string, review_score int, review_creation_date timestamp_ntz",
    )
    customers = spark.createDataFrame([(f"c{i}", f"g{i % 2}") for i in range(2)], "customer_id string, city_key string")
    sellers = spark.createDataFrame([(f"s{i}", f"h{i % 2}") for i in range(4)], "seller_id string, city_key string")
    products = spark.createDataFrame([(f"p{i}", f"k{i % 2}") for i in range(3)], "product_id string, category_key string")
    t = {
        "dim_customer": scd2_initial(customers, "customer_id", "customer_key"),
        "dim_seller": scd2_initial(sellers, "seller_id", "seller_key"),
        "dim_product": scd2_initial(products, "product_id", "product_key"),
        "dim_product_category": spark.createDataFrame([("k0", "x", "toys")], "category_key string, category_name_pt string, category_name_en string"),
        "dim_time": dims.dim_time(spark),
    }
    t["fact_sales"] = facts.fact_sales(orders, items, t["dim_customer"], t["dim_seller"], t["dim_product"]).cache()
    t["fact_reviews"] = facts.fact_reviews(reviews, orders, items, t["dim_customer"], t["dim_product"]).cache()
    t["fact_shipment"] = facts.fact_shipment(orders, items, t["dim_customer"], t["dim_seller"]).cache()
    t["orders"], t["items"], t["reviews"] = orders, items, reviews
    return t


def test_facts_keep_their_grain(star):
    triples = star["items"].select("order_id", "product_id", "seller_id").distinct().count()
    assert star["fact_sales"].count() == triples
    assert star["fact_reviews"].count() == star["reviews"].count()
    assert star["fact_shipment"].count() == star["items"].select("order_id").distinct().count()
    line = star["fact_sales"].where("order_id = 'o0'").orderBy("sale_price").first()
    assert line.total_value == line.sale_price * line.quantity


def as_cells(df, keys):
    return {
        tuple(r[k] for k in keys): {
            c: None if r[c] is None else round(float(r[c]), 9) for c in df.columns if c not in keys
        }
        for r in df.collect()
    }


def test_experience_mart_equals_the_joined_rows(star):
    fr, fs = star["fact_reviews"], star["fact_sales"].withColumnRenamed("product_key", "line_product")
    joined = (
        fr.join(fs, fr["Order_id"] == fs["order_id"], "left")
        .join(star["dim_time"].select("time_key", F.col("full_date").alias("date")), "time_key", "left")
        .join(star["dim_product"].select("product_key", "category_key"), "product_key", "left")
        .join(star["dim_product_category"], "category_key", "left")
        .join(star["dim_seller"].select("seller_key", F.col("city_key").alias("seller_geo_key")), "seller_key", "left")
    )
    keys = ["date", "product_category", "seller_geo_key"]
    wanted = joined.groupBy("date", F.col("category_name_en").alias("product_category"), "seller_geo_key").agg(
        F.avg("Review_score").alias("avg_review_score"),
        F.avg(F.when(F.col("Review_score") >= 4, 1).otherwise(0)).alias("good_review_rate"),
        F.avg(F.when(F.col("Review_score") <= 2, 1).otherwise(0)).alias("bad_review_rate"),
        F.lit(0.0).alias("avg_delivery_delay"),
        F.lit(0.0).alias("late_delivery_rate"),
        F.avg(F.col("freight_value").cast("double")).alias("avg_freight_value"),
        F.avg(F.col("sale_price").cast("double")).alias("avg_price"),
        F.count(F.lit(1)).alias("review_volume"),
    )
    assert as_cells(marts.build_mart("customer_experience_mart", star), keys) == as_cells(wanted, keys)


def test_logistics_mart_equals_the_joined_rows(star):
    def day(c):
        return F.to_date(F.col(c).cast("string"), "yyyyMMdd")

    joined = (
        star["fact_shipment"]
        .join(star["fact_sales"].select("order_id", day("purchase_time_key").alias("date")), "order_id", "left")
        .join(star["dim_customer"].select("customer_key", F.col("city_key").alias("customer_geo_key")), "customer_key", "left")
        .join(star["dim_seller"].select("seller_key", F.col("city_key").alias("seller_geo_key")), "seller_key", "left")
        .withColumn("taken", F.datediff(day("delivered_customer_date"), "date"))
        .withColumn("delay", F.datediff(day("delivered_customer_date"), day("estimated_delivery_date")))
    )
    keys = ["seller_geo_key", "customer_geo_key", "date"]
    wanted = joined.groupBy(*keys).agg(
        F.avg("taken").alias("avg_delivery_time"),
        F.avg("delay").alias("avg_delivery_delay"),
        F.avg(F.when(F.col("delay") > 0, 1).otherwise(0)).alias("late_delivery_rate"),
        F.avg(F.when(F.col("delay") <= 0, 1).otherwise(0)).alias("on_time_rate"),
        F.avg("taken").alias("avg_shipping_duration"),
        F.avg("taken").alias("carrier_to_customer_days"),
        F.count(F.lit(1)).alias("order_volume"),
    )
    assert as_cells(marts.build_mart("logistics_mart", star), keys) == as_cells(wanted, keys)


def test_revenue_mart_totals(star):
    mart = marts.build_mart("revenue_mart", star)
    totals = mart.agg(F.sum("total_revenue"), F.sum("total_items_sold")).first()
    sales = star["fact_sales"].agg(F.sum(F.col("sale_price") + F.col("freight_value")), F.sum("quantity")).first()
    assert tuple(totals) == tuple(sales)


def test_fact_reload_with_null_dimension_keys(spark, star, rows, tmp_path):
    """Lines whose product or seller no dimension has yet keep one row each over any reloads."""
    lines = [("o1", "p1", "s1"), ("o1", "p2", "s2"), ("o1", "p3", "s2"), ("o1", None, "s2"), ("o2", "p1", None)]
    held = spark.createDataFrame(lines, "order_id string, product_id string, seller_id string")
    held = held.withColumn("product_key", F.lit(None).cast("string")).withColumn("seller_key", F.lit(None).cast("string"))
    late = held.withColumn("product_key", F.when(F.col("product_id") == "p2", "k2"))
    table = held
    for fresh in (held, late, late):
        table = facts.merge_fact("fact_sales", table, fresh)
        assert table.where("_action = 'insert'").isEmpty()
        table = spark.createDataFrame(table.drop("_action").collect(), held.schema)
    assert rows(table) == rows(late)
    assert not star["fact_sales"].where("product_key IS NULL").isEmpty()


def test_first_item_is_by_number(spark, rows):
    items = spark.createDataFrame(
        [("o", "10", "a", "x", None), ("o", "2", "b", "y", None)],
        "order_id string, order_item_id string, product_id string, seller_id string, shipping_limit_date timestamp_ntz",
    )
    assert rows(facts.first_products(items)) == [("o", "b")]
    assert rows(facts.first_items(items), "seller_id") == [("y",)]


def test_unknown_mart(star):
    with pytest.raises(ValueError):
        marts.build_mart("nothing", star)
