"""The whole flow over one root folder: loads, a batch of changes, loads again."""

import json
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.__main__ import parser
from millrace.jobs import Lakehouse
from millrace.plans.marts import MARTS
from millrace.sources.entities import ENTITIES
from millrace.streaming.feed import DRAIN

N = 60
T0 = datetime(2018, 1, 1)
def clock():
    return F.lit("2018-03-01 00:00:00").cast("timestamp_ntz")



def ms(day):
    return str(int((T0 + timedelta(days=day) - datetime(1970, 1, 1)).total_seconds() * 1000))


def order(i, status="delivered"):
    return {
        "order_id": f"o{i}", "customer_id": f"c{i}", "order_status": status,
        "order_purchase_timestamp": ms(i % 20), "order_approved_at": ms(i % 20),
        "order_delivered_carrier_date": ms(i % 20 + 2) if status == "delivered" else None,
        "order_delivered_customer_date": ms(i % 20 + 3 + i % 9) if status == "delivered" else None,
        "order_estimated_delivery_date": ms(i % 20 + 8),
    }


def item(i, price="10.00"):
    return {
        "order_id": f"o{i}", "order_item_id": "1", "product_id": f"p{i % 7}", "seller_id": f"s{i % 5}",
        "shipping_limit_date": ms(i % 20 + 1), "price": price, "freight_value": f"{i % 13}.50",
    }


class Source:
    """The operational tables, as frames, and the change feeds' topics, as folders."""

    def __init__(self, spark, root):
        self.spark, self.root, self.offset = spark, root, 0
        self.customers = {f"c{i}": (f"u{i}", str(i % 30), " Hue ", "th", T0) for i in range(N)}
        self.reviews = {f"r{i}": (f"o{i}", i * 7 % 5 + 1, T0 + timedelta(days=30), T0) for i in range(N)}

    def frame(self, name, rows):
        return self.spark.createDataFrame(rows, ENTITIES[name].ddl)

    def table(self, name):
        if name == "customers":
            return self.frame(name, [(k, u, z, c, s, T0, m) for k, (u, z, c, s, m) in self.customers.items()])
        if name == "order_reviews":
            rows = [(k, o, s, None, "text", d, None, T0, m) for k, (o, s, d, m) in self.reviews.items()]
            return self.frame(name, rows)
        if name == "sellers":
            return self.frame(name, [(f"s{i}", str(i), "x", "y", T0, T0) for i in range(5)])
        if name == "products":
            one = Decimal("1.00")
            return self.frame(name, [(f"p{i}", f"cat{i % 3}", 1, 1, 1, one, one, one, one, T0, T0) for i in range(7)])
        if name == "product_category_name_translation":
            return self.frame(name, [(f"cat{i}", f"category {i}", T0, T0) for i in range(3)])
        if name == "geolocation":
            return self.frame(name, [(str(i), Decimal(i), Decimal(i), "x", "y", T0, T0) for i in range(31)])
        payments = [(i, f"o{i}", 1, "Voucher", i % 3, Decimal(i), T0, T0) for i in range(N)]
        return self.frame("order_payments", payments)

    def emit(self, topic, changes):
        rows = []
        for op, record, ts in changes:
            side = "before" if op == "d" else "after"
            value = json.dumps({"payload": {side: record, "op": op, "source": {"ts_ms": ts}}})
            self.offset += 1
            rows.append((value, self.offset))
        self.spark.createDataFrame(rows, "value string, offset long").write.mode("append").parquet(
            f"{self.root}/topics/{topic}"
        )

    def feeds(self):
        return {
            t: self.spark.readStream.schema("value string, offset long").parquet(f"{self.root}/topics/{t}")
            for t in ("orders", "order_items")
        }


def refresh(house, source, day, now):
    batch = [n for n, e in ENTITIES.items() if e.mode != "cdc"]
    for name in batch:
        house.extract(name, source.table(name), T0 + timedelta(days=day))
    for query in house.land_changes(source.feeds(), clock(), trigger=DRAIN).values():
        assert query.awaitTermination(120) and query.exception() is None
    for name, entity in ENTITIES.items():
        keys = source.table(name).select(*entity.keys) if entity.mode == "incremental" else None
        house.refresh_entity(name, keys)
    house.refresh_dimensions(now)
    house.refresh_facts()
    for name in MARTS:
        house.refresh_mart(name)


@pytest.fixture(scope="module")
def flow(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lakehouse"))
    source, house = Source(spark, root), Lakehouse(spark, root)
    source.emit("orders", [("c", order(i), 1) for i in range(N)])
    source.emit("order_items", [("c", item(i), 1) for i in range(N)])
    refresh(house, source, 60, "2018-02-01 00:00:00")
    first = {n: house.warehouse.read(n).count() for n in ("dim_customer", "fact_sales", "fact_reviews")}

    # Customers move and join, prices rise, lines and reviews are deleted, orders change state.
    later = T0 + timedelta(days=70)
    for i in range(N, N + 50):
        source.customers[f"c{i}"] = (f"u{i}", "30", "ho chi minh", "SG", later)
    for i in range(50):
        u, _, _, _, _ = source.customers[f"c{i}"]
        source.customers[f"c{i}"] = (u, "29", "da nang", "DN", later)
    for i in range(N, N + 50):
        source.reviews[f"r{i}"] = (f"o{i}", 5, later, later)
    del source.reviews["r1"], source.customers["c59"]
    source.emit("orders", [("c", order(i, "created"), 2) for i in range(N, N + 50)])
    source.emit("order_items", [("c", item(i), 2) for i in range(N, N + 50)])
    source.emit("orders", [("u", order(i), 3) for i in range(N, N + 10)])
    source.emit("order_items", [("u", item(i, "11.00"), 3) for i in range(10)] + [("d", item(i), 3) for i in range(20, 30)])
    refresh(house, source, 70, "2018-03-15 00:00:00")
    return source, house, first


def test_first_load(flow):
    _, _, first = flow
    assert first == {"dim_customer": N, "fact_sales": N, "fact_reviews": N}


def test_customers_are_not_duplicated(flow):
    _, house, _ = flow
    customers = house.warehouse.entity("customers")
    assert customers.count() == customers.select("customer_id").distinct().count() == N + 50
    assert customers.where("customer_city = 'da nang'").count() == 50
    assert [r.customer_id for r in customers.where("NOT is_active").collect()] == ["c59"]


def test_deleted_lines_and_reviews_stay_inactive(flow):
    _, house, _ = flow
    items = house.warehouse.entity("order_items")
    assert items.count() == N + 50 and items.where("NOT is_active").count() == 10
    assert items.where("price = 11").count() == 10
    reviews = house.warehouse.entity("order_reviews")
    assert [r.review_id for r in reviews.where("NOT is_active").collect()] == ["r1"]


def test_moved_customers_have_two_versions(flow):
    _, house, _ = flow
    dimension = house.warehouse.read("dim_customer")
    moved = dimension.where("customer_id IN ('c3')").orderBy("effective_date").collect()
    assert [r.is_current for r in moved] == [0, 1] and moved[0].expiry_date == datetime(2018, 3, 15)
    assert dimension.where("is_current = 1").count() == N + 50


def test_facts_are_merged(flow):
    _, house, _ = flow
    sales = house.warehouse.read("fact_sales")
    assert sales.count() == N + 50
    assert sales.where("sale_price = 11").count() == 10
    assert house.warehouse.read("fact_shipment").count() == N + 50


def test_published_tables_answer_sql(flow, spark):
    _, house, _ = flow
    house.warehouse.publish()
    for name in MARTS:
        assert spark.sql(f"SELECT * FROM mart_db.{name}").count() > 0
    orders = spark.sql("SELECT sum(total_orders) FROM mart_db.revenue_mart").first()[0]
    assert orders == N + 50
    assert spark.sql("SELECT count(*) FROM silver.clean_customers").first()[0] == N + 50


def test_features_training_and_scoring(flow):
    _, house, _ = flow
    house.refresh_features()
    report, threshold, area = house.train()
    assert report.count() == 5 and threshold == 0.55 and 0 <= area <= 1
    house.score("2018-03-16 00:00:00", threshold=1.1)
    path = house.path("alerts")
    once = house.spark.read.parquet(path).count()
    assert once > 0
    house.score("2018-03-17 00:00:00", threshold=1.1)
    assert house.spark.read.parquet(path).count() == once


def test_seed_files(spark, tmp_path):
    (tmp_path / "product_category_name_translation.csv").write_bytes(
        b"\xef\xbb\xbfproduct_category_name,product_category_name_english\nauto,car\nauto,car\n"
    )
    (tmp_path / "shop_sellers_dataset.csv").write_text(
        "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,01234,x,y\n"
    )
    house = Lakehouse(spark, str(tmp_path / "root"))
    names = ("sellers", "product_category_name_translation")
    assert house.seed(str(tmp_path)) == dict.fromkeys(names, True)
    assert house.seed(str(tmp_path)) == dict.fromkeys(names, False)
    assert spark.read.parquet(house.path("source", "sellers", "v=*")).first().seller_zip_code_prefix == "01234"


def test_command_line():
    args = parser().parse_args(["mart", "--root", "r", "--table_name", "revenue_mart"])
    assert (args.job, args.table_name) == ("mart", "revenue_mart")
    with pytest.raises(SystemExit):
        parser().parse_args(["mart", "--root", "r", "--table_name", "nothing"])
