"""Columns that are packed or numbered for shuffles, and the bytes that the sales load and revenue mart shuffle."""

from __future__ import annotations

import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from millrace.functions.columns import pack, packed_number, unpack, unpacked_number, version_key
from millrace.operators import scd
from millrace.plans import facts, marts
from millrace.suite import queries
from tests.conftest import TESTDATA
from tests.test_mart_shuffles import key, star  # noqa: F401
from tests.test_sales_lines import tables  # noqa: F401
from tests.test_skew import final_plan, settings

# Nothing is broadcast by its size, few rows by their number.
COUNTED = {
    "spark.sql.autoBroadcastJoinThreshold": "1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "4",
}


def test_numbers_come_back(spark):
    texts = ["0", "7", "00", "-1", "", " 7", "+7", "1e3", "255", "256", str(2**63 - 1), str(2**63), "ab", "ü", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", packed_number("t").alias("p")).select("t", "p", unpacked_number("p").alias("again")).collect()
    assert all(r.t == r.again for r in rows) and len({r.p for r in rows}) == len(texts)
    assert [len(r.p) for r in rows if r.t in ("255", "256")] == [2, 3]


def test_packed_columns_come_back(spark):
    bits = {"price": 10, "day": 15, "n": 4, "word": 9}
    values = [
        ("5.11", date(2020, 1, 1), 3, "a"),
        ("0.00", date(1970, 1, 1), 15, None),
        ("10.24", date(2020, 1, 1), 3, "a"),
        ("-0.01", date(2020, 1, 1), 3, "a"),
        ("9" * 20 + ".99", date(2020, 1, 1), 3, "a"),
        ("5.11", date(1969, 12, 31), 3, "a"),
        ("5.11", None, 3, "a"),
        (None, None, None, None),
    ]
    df = spark.createDataFrame(values, "price string, day date, n int, word string")
    df = df.withColumn("price", F.col("price").cast("decimal(22,2)"))
    packed = pack(df, bits, "_all")
    assert [r._all is not None for r in packed.collect()] == [True, True] + 6 * [False]
    again = unpack(packed, bits, "_all")
    assert again.schema == df.schema and again.collect() == df.collect()


@pytest.mark.parametrize("few", [scd.BROADCAST_VERSIONS, 0])
def test_revenue_by_numbers(spark, star, few, monkeypatch):  # noqa: F811
    """Cells by numbers, and by values where these are too many; unknown keys and no key make a cell of nulls."""
    monkeypatch.setattr(scd, "BROADCAST_VERSIONS", few)
    with settings(spark, COUNTED):
        mart = marts.build_mart("revenue_mart", star)
        rows = mart.collect()
        plan = final_plan(mart)
    got = {(r.product_category, r.seller_key, r.customer_geo_key): (r.total_orders, int(r.total_revenue), r.total_items_sold) for r in rows}
    assert got == {("toys", key(1), "city customer"): (2, 24, 3), (None, None, None): (1, 2, 1)}
    assert {r.date for r in rows} == {date(2020, 1, 10)}
    assert ("_number" in plan) == (few > 0)


def shuffled(df) -> int:
    """Bytes that the shuffles of ``df`` write."""
    df._jdf.queryExecution().toRdd().count()
    nodes, total = [df._jdf.queryExecution().executedPlan()], 0
    while nodes:
        plan = nodes.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            nodes.append(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            nodes.append(plan.plan())
        elif kind == "ShuffleExchangeExec":
            total += plan.metrics().apply("shuffleBytesWritten").value()
        children = plan.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return total


LINES = 40_000


@pytest.fixture(scope="module")
def wide_star(spark):
    """A star of which customers and products are too many to be broadcast under ``counted``."""
    order = F.expr("id div 4")
    orders = spark.range(LINES).select(
        (order + 1_000_000).cast("string").alias("order_id"),
        F.md5((F.xxhash64(order) % 1500).cast("string")).alias("customer_key"),
        F.md5((F.xxhash64("id") % 1500).cast("string")).alias("product_key"),
        F.md5((F.xxhash64("id") % 499).cast("string")).alias("seller_key"),
        F.lit(20200110).alias("purchase_time_key"),
        (F.pmod(F.xxhash64("id"), F.lit(9_000_000)) / 100).cast("decimal(12,2)").alias("sale_price"),
        F.lit(1).cast("bigint").alias("quantity"),
        (F.pmod(F.xxhash64("id", F.lit(7)), F.lit(90_000)) / 100).cast("decimal(22,2)").alias("freight_value"),
    )
    side = {c: orders.select(f"{c}_key").distinct() for c in ("customer", "product", "seller")}
    cities = F.concat(F.lit("city "), (F.xxhash64("customer_key") % 900).cast("string"))
    t = {
        "fact_sales": orders,
        "dim_customer": side["customer"].select("customer_key", F.md5(cities).alias("city_key")),
        "dim_seller": side["seller"].withColumn("city_key", F.lit("s")),
        "dim_product": side["product"].withColumn("category_key", F.lit("c")),
        "dim_product_category": spark.createDataFrame([("c", "toys")], "category_key string, category_name_en string"),
        "dim_time": spark.createDataFrame([(20200110, date(2020, 1, 10))], "time_key int, full_date date"),
    }
    t = {name: df.localCheckpoint() for name, df in t.items()}
    t |= {name: F.broadcast(t[name]) for name in ("dim_time", "dim_product_category")}
    return t


@pytest.fixture
def counted(spark, monkeypatch):
    monkeypatch.setattr(scd, "BROADCAST_VERSIONS", 1000)
    with settings(spark, COUNTED):
        yield


def test_revenue_lines_are_narrow_in_shuffles(wide_star, counted):
    """Three shuffles of lines, and the dimensions': 197 bytes a line before columns were packed, 158 with that."""
    mart = marts.build_mart("revenue_mart", wide_star)
    assert mart.agg(F.sum("total_items_sold")).first()[0] == LINES
    assert shuffled(mart) < 175 * LINES


def test_star_lines_are_narrow_in_shuffles(spark, wide_star, counted, monkeypatch):
    """Two shuffles of lines, and the dimensions': 111 bytes a line before, 84 with packed columns."""
    monkeypatch.setattr(queries, "_stored", lambda s, *names: wide_star)
    lines = queries.QUERIES["join_star"](spark, str(TESTDATA))
    assert lines.where("customer_city_key IS NOT NULL AND seller_city_key = 's' AND category_name_en = 'toys'").count() == LINES
    assert shuffled(lines) < 100 * LINES


@pytest.mark.parametrize("conf", [{}, COUNTED])
def test_star_keeps_unknown_keys(spark, star, conf, monkeypatch):  # noqa: F811
    """Sellers that no dimension knows keep their key; the sides of unknown keys are NULL."""
    monkeypatch.setattr(queries, "_stored", lambda s, *names: star)
    with settings(spark, conf):
        rows = queries.QUERIES["join_star"](spark, str(TESTDATA)).collect()
    got = {(r.order_id, r.product_key, r.seller_key, r.quantity, r.full_date, r.category_name_en, r.customer_city_key, r.seller_city_key) for r in rows}
    day, known = date(2020, 1, 10), ("toys", "city customer", "city seller")
    lines = [("1", key(1)), ("1", key(2)), ("2", key(2))]
    assert len(rows) == 4
    assert got == {(o, p, key(1), 1, day, *known) for o, p in lines} | {("3", "plain", key(9), 1, day, None, None, None)}


def test_versions_are_listed_without_their_digests(spark, tables):  # noqa: F811
    """Surrogates of key and start are made again after the shuffle; any other is carried."""
    _, _, _, _, product = tables
    made = product.withColumn("product_key", F.when(F.col("product_id") == "p", version_key("product_id", F.col("effective_date"))).otherwise(F.col("product_key")))
    items = spark.createDataFrame([("p",), ("q",), ("r",), (None,)], "product_id string").select("product_id", packed_number("product_id").alias("id"))
    listed = scd.with_versions(items, made, "id", "product_id", "product_key", "_versions")
    lists = {r.product_id: r._versions for r in listed.collect()}
    assert {bytes(v.key) for v in lists["p"]} == {b""} and [bytes(v.key) for v in lists["q"]] == [b"\x00early"]
    assert lists["r"] is None and lists[None] is None
    picked = listed.withColumn("v", F.explode("_versions")).select("product_id", scd.valid_surrogate("v", "product_id").alias("k"))
    wanted = made.where("product_id IS NOT NULL").select("product_id", "product_key").collect()
    assert sorted(map(tuple, picked.collect())) == sorted(map(tuple, wanted))


def test_sales_with_made_surrogates(spark, tables):  # noqa: F811
    orders, items, customer, seller, product = tables
    product = product.withColumn("product_key", version_key("product_id", F.col("effective_date")))
    rows = facts.sales_lines(orders, items, customer, seller, product).collect()
    valid = {r.product_key for r in product.where("product_id = 'p' AND expiry_date IS NULL").collect()}
    assert {r.product_key for r in rows if r.product_id == "p" and r.order_id == "1"} == valid


def test_shuffle_files_go_with_their_write(spark, tmp_path):
    """A load leaves its table, not the files of its shuffles, though the driver's garbage stays."""

    def files() -> set[str]:
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {n for n in (blocks.apply(i).name() for i in range(blocks.size())) if n.startswith("shuffle_")}

    before = files()
    rows = spark.range(100_000).groupBy((F.col("id") % 50_021).alias("k")).count()
    assert len(rows.collect()) == 50_021
    # Their job is still referred to; they are removed in the background.
    time.sleep(2)
    assert not files() - before
    assert len(rows.collect()) == rows.count() == 50_021


SALES = "order_id string, product_id string, seller_id string, customer_key string, product_key string, seller_key string, purchase_time_key int, quantity bigint, is_canceled int, delay int"


@pytest.fixture
def sales(spark):
    """Held and fresh sales: NULL and odd ids, surrogates of first versions, of later ones and plain ones."""
    def frame(*lines):
        rows = spark.createDataFrame([(*line, 20200110, n, 0, -n) for n, line in enumerate(lines)], SALES)
        first = version_key("product_id", F.lit(scd.FIRST_EFFECTIVE).cast("timestamp_ntz"))
        return rows.withColumn("product_key", F.when(F.col("product_key") == "first", first).otherwise(F.col("product_key")))

    held = frame(("1", "7", "s", key(1), "first", key(2)), ("2", None, "s", None, None, key(2)), (None, "07", None, key(3), key(4), None))
    fresh = frame(("2", None, "s", key(9), "plain", None), ("1", "7", "", key(1), "first", ""))
    return held, fresh


def test_merged_sales_come_back(sales):
    held, fresh = sales
    merged = facts.merge_fact("fact_sales", held, fresh)
    got = {tuple(r) for r in merged.collect()}
    old, new = held.collect(), fresh.collect()
    assert got == {(*old[0], "keep"), (*new[0], "update"), (*old[2], "keep"), (*new[1], "insert")}
    assert merged.drop("_action").dtypes == held.dtypes


def test_merge_checks_keys_where_it_joins_them(spark, sales):
    """The source is read once, shuffled once, and a key that it repeats is an error."""
    held, fresh = sales
    with settings(spark, {**COUNTED, "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = final_plan(facts.merge_fact("fact_sales", held, fresh))
        assert plan.count("Exchange hashpartitioning(") == 2 and "ubquery" not in plan
        with pytest.raises(Exception, match="several rows for one key"):
            facts.merge_fact("fact_sales", held, fresh.union(fresh)).collect()
