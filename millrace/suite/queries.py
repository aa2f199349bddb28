"""Every operator as a query over the supplied test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from millrace.functions import cleaning
from millrace.functions.columns import (
    date_key,
    exact_mean,
    hash_key,
    key_date,
    pack,
    packed_key,
    packed_number,
    rate,
    ratio,
    unpack,
    unpacked_key,
    unpacked_number,
)
from millrace.ml import evaluation, model, scoring
from millrace.ml.expression import Weights
from millrace.operators import dedup, merge, scd
from millrace.plans import dimensions as dims
from millrace.plans import facts, features, insights, marts
from millrace.session import fits_broadcast, plan_bytes, shared_dir, stored
from millrace.sources import catalog, landing, readers
from millrace.sources.entities import CHANGE_RECORD_DDL
from millrace.sources.tables import PartitionedTable, SnapshotTable, delete_path
from millrace.streaming import feed, silver
from millrace.suite.views import Source

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

USER_DDL = "user_id STRING, event_type STRING"
# Thresholds tried in one pass.
CANDIDATE_THRESHOLDS = (0.1, 0.25, 0.4, 0.55, 0.7)
# A fitted model of good reviews; feature, mean, deviation, coefficient.
REVIEW_WEIGHTS = (
    ("delivery_delay", -1.563, 8.798, 0.2284),
    ("delivery_time", 17.98, 8.369, -0.2497),
    ("price_sum", 217200.0, 122300.0, -0.04948),
    ("price_mean", 52880.0, 17570.0, 0.02555),
    ("freight_sum", 8697.0, 5627.0, 0.004484),
    ("freight_mean", 2123.0, 1078.0, -0.002712),
    ("freight_ratio", 0.04011, 0.0148, -0.003099),
    ("item_count", 4.084, 1.964, -0.002133),
    ("is_high_freight", 0.0, 0.0, 0.0),
    ("price_per_item", 52880.0, 17570.0, 0.02555),
    ("delay_ratio", -0.4185, 0.8944, 0.03479),
)
REVIEW_INTERCEPT = 0.02429
# Watermark between the first and the second extract.
MID_JANUARY = "2024-01-15 00:00:00"


def query(build: Callable[[Source], DataFrame]):
    """Register under the function's name; decimals are delivered as doubles."""

    @wraps(build)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        result = build(Source(spark, folder))
        return result.select(
            *[
                F.col(f.name).cast("double").alias(f.name)
                if isinstance(f.dataType, DecimalType)
                else F.col(f.name)
                for f in result.schema.fields
            ]
        )

    QUERIES[build.__name__] = run
    return build


# --- ingestion ---


@query
def ingest_csv_clean(s: Source) -> DataFrame:
    rows = s.customers()
    blank = s.table("region").select(*[F.lit(None).cast("string").alias(c) for c in rows.columns])
    path = shared_dir(s.spark, "seed")
    rows.unionByName(rows).unionByName(blank).write.option("header", True).option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    schema = ", ".join(f"{c} string" for c in rows.columns)
    table = SnapshotTable(s.spark, shared_dir(s.spark, "seeded"))
    seeded = landing.without_noise(readers.read_csv(s.spark, path, schema))
    landing.load_once(seeded, table)
    landing.load_once(seeded, table)  # the second load is skipped
    return table.read()


@query
def load_audit_counts(s: Source) -> DataFrame:
    names = ("customer", "supplier", "part", "orders", "lineitem", "events", "nation", "region")
    return readers.row_counts({name: s.table(name) for name in names})


@query
def extract_full_snapshot(s: Source) -> DataFrame:
    path = shared_dir(s.spark, "bronze-orders")
    landing.extract_full(s.orders(), path, "orders")
    return readers.read_parquet(s.spark, path)


def _extract_events(s: Source, path: str, rows: DataFrame, last: str | None, day: datetime) -> dict:
    return landing.extract_incremental(rows, path, "order_reviews", "ts", last, day)


@query
def extract_incremental(s: Source) -> DataFrame:
    path = shared_dir(s.spark, "bronze-reviews")
    _extract_events(s, path, s.table("events"), MID_JANUARY, datetime(2024, 2, 1))
    return readers.read_parquet(s.spark, path)


@query
def watermark_advance(s: Source) -> DataFrame:
    store = landing.WatermarkStore(s.spark, shared_dir(s.spark, "watermarks"))
    path = shared_dir(s.spark, "bronze")
    events, payments = s.table("events"), s.order_payments()
    early = events.where(F.col("ts") <= F.lit(MID_JANUARY).cast("timestamp_ntz"))
    for rows in (early, events, events):  # the third extract finds nothing and is skipped
        store.advance(
            _extract_events(
                s, f"{path}/order_reviews", rows, store.get("order_reviews"), datetime(2024, 2, 1)
            )
        )
    store.advance(
        landing.extract_incremental(
            payments,
            f"{path}/order_payments",
            "order_payments",
            "last_modified_date",
            store.get("order_payments"),
            datetime(2024, 2, 1),
        )
    )
    return store.read()


@query
def bronze_partitioned_landing(s: Source) -> DataFrame:
    path = shared_dir(s.spark, "bronze-events")
    events = s.table("events")
    early = events.where(F.col("ts") <= F.lit(MID_JANUARY).cast("timestamp_ntz"))
    first = _extract_events(s, path, early, None, datetime(2024, 1, 15))
    _extract_events(s, path, events, first.get("new_watermark"), datetime(2024, 2, 1))
    return (
        readers.read_parquet(s.spark, path)
        .groupBy("year", "month", "day")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min("ts").alias("oldest"),
            F.max("ts").alias("newest"),
        )
    )


# --- cleaning ---


@query
def clean_trim_all(s: Source) -> DataFrame:
    return cleaning.trim_all(s.order_reviews())


@query
def clean_customers(s: Source) -> DataFrame:
    return s.clean("customers")


@query
def clean_sellers(s: Source) -> DataFrame:
    return s.clean("sellers")


@query
def clean_orders(s: Source) -> DataFrame:
    return cleaning.clean(s.orders_feed_rows(), "orders")


@query
def clean_order_items(s: Source) -> DataFrame:
    return cleaning.clean(s.order_items_feed_rows(), "order_items")


@query
def clean_order_payments(s: Source) -> DataFrame:
    return s.clean("order_payments")


@query
def clean_order_reviews(s: Source) -> DataFrame:
    return s.clean("order_reviews")


@query
def clean_products(s: Source) -> DataFrame:
    return s.clean("products")


@query
def clean_geolocation(s: Source) -> DataFrame:
    return s.clean("geolocation")


@query
def clean_category_translation(s: Source) -> DataFrame:
    return s.clean("product_category_name_translation")


# --- one row per key ---


@query
def dedup_latest_full(s: Source) -> DataFrame:
    return dedup.latest_per_key(s.clean("order_payments"), ["order_id"], ["last_modified_date"])


@query
def dedup_latest_composite(s: Source) -> DataFrame:
    keys = ["order_id", "order_item_id"]
    return dedup.latest_per_key(s.clean("order_items"), keys, ["shipping_limit_date"])


def _user_changes(s: Source) -> DataFrame:
    return feed.accepted(feed.parse_envelope(s.change_feed(), carry=["seq"]))


@query
def dedup_latest_cdc(s: Source) -> DataFrame:
    return silver.change_rows(_user_changes(s), USER_DDL, ["user_id"], sequence="seq")


@query
def dedup_one_per_key(s: Source) -> DataFrame:
    return facts.first_items(s.clean("order_items"))


@query
def distinct_values(s: Source) -> DataFrame:
    return dedup.distinct_values(s.clean("order_payments"), "payment_type")


# --- merge ---

_PURCHASE = "order_purchase_timestamp"


def _orders_held(s: Source) -> DataFrame:
    return s.clean("orders").where(F.col(_PURCHASE) < F.lit("1999-01-01").cast("timestamp_ntz"))


def _orders_given(s: Source) -> DataFrame:
    """Later orders; the overlap with the held ones has another status."""
    rows = s.clean("orders").where(
        F.col(_PURCHASE) >= F.lit("1997-01-01").cast("timestamp_ntz")
    )
    return rows.withColumn("order_status", F.concat("order_status", F.lit("+")))


@query
def merge_upsert(s: Source) -> DataFrame:
    return merge.merge_into(_orders_held(s), _orders_given(s), ["order_id"])


@query
def upsert_all_columns(s: Source) -> DataFrame:
    return merge.upsert(_orders_held(s), _orders_given(s), ["order_id"])


@query
def merge_metrics(s: Source) -> DataFrame:
    return merge.merge_metrics(_customers_synced(s))


@query
def merge_schema_evolution(s: Source) -> DataFrame:
    priorities = s.table("orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"), "o_orderpriority"
    )
    given = _orders_given(s).drop("order_approved_at").join(priorities, "order_id")
    return merge.merge_into(_orders_held(s), given, ["order_id"])


def _active(df: DataFrame) -> DataFrame:
    return df.withColumn("is_active", F.lit(True))


def _customers_synced(s: Source) -> DataFrame:
    return merge.sync_snapshot(
        _active(s.clean("customers")), _active(s.clean_next("customers")), ["customer_id"]
    )


@query
def merge_snapshot_soft_delete(s: Source) -> DataFrame:
    return _customers_synced(s)


@query
def merge_reactivate(s: Source) -> DataFrame:
    """The first snapshot comes back after the second: lost customers are active again."""
    held = _customers_synced(s).drop(merge.ACTION)
    return merge.sync_snapshot(held, _active(s.clean("customers")), ["customer_id"])


@query
def merge_cdc(s: Source) -> DataFrame:
    """The feed in two batches, the later one applied first."""
    changes = _user_changes(s)
    middle = F.lit(1705276800000)  # 2024-01-15 00:00:00
    later, earlier = (
        silver.change_rows(changes.where(part), USER_DDL, ["user_id"], sequence="seq")
        for part in (F.col("ts_ms") >= middle, F.col("ts_ms") < middle)
    )
    order = [silver.CHANGE_TIME, silver.CHANGE_SEQUENCE]
    return merge.upsert(later, earlier, ["user_id"], newer_by=order)


@query
def hard_delete_sweep(s: Source) -> DataFrame:
    return merge.sweep_deleted(
        _active(s.clean("customers")), s.clean_next("customers"), ["customer_id"]
    )


# --- slowly changing dimensions ---

_CUSTOMER = (dims.CUSTOMER.business_key, dims.CUSTOMER.surrogate)


@query
def scd2_initial(s: Source) -> DataFrame:
    first, _ = s.batches("dim_customer")
    return scd.scd2_initial(first, *_CUSTOMER)


@query
def scd2_detect_changes(s: Source) -> DataFrame:
    first, second = s.batches("dim_customer")
    held = scd.scd2_initial(first, *_CUSTOMER)
    return scd.scd2_changed(held, second, dims.CUSTOMER.business_key, dims.CUSTOMER.tracked)


@query
def scd2_staged(s: Source) -> DataFrame:
    first, second = s.batches("dim_customer")
    held = scd.scd2_initial(first, *_CUSTOMER)
    return scd.scd2_staged(held, second, dims.CUSTOMER.business_key, dims.CUSTOMER.tracked)


@query
def scd2_apply(s: Source) -> DataFrame:
    return s.versioned("dim_customer")


@query
def scd2_surrogate_key(s: Source) -> DataFrame:
    return s.versioned("dim_product").select("product_id", "effective_date", "product_key")


@query
def fact_merge_incremental(s: Source) -> DataFrame:
    """Sales of the early lines, then those of the later ones, which overlap, merged in."""
    limit = F.col("shipping_limit_date")
    items = s.clean("order_items")
    early = items.where(limit < F.lit("1999-01-01").cast("timestamp_ntz"))
    late = items.where(limit >= F.lit("1998-01-01").cast("timestamp_ntz"))
    held, fresh = (s.fact("sales_lines", order_items=lines) for lines in (early, late))
    return facts.merge_fact("fact_sales", held, fresh).drop("product_id", "seller_id")


@query
def fact_reload(s: Source) -> DataFrame:
    """Sales loaded three times: of the products and sellers that the first load lacks, the second
    has most; every fifth stays unknown, so that lines keep NULL keys. No line is ever doubled."""
    e = s.entities()
    customer, seller, product = (s.stored(f"dim_{n}") for n in ("customer", "seller", "product"))

    def load(known) -> DataFrame:
        return facts.sales_lines(
            e["orders"], e["order_items"], customer, seller.where(known("seller_id")), product.where(known("product_id"))
        )

    table = SnapshotTable(s.spark, shared_dir(s.spark, "sales"))
    table.write(load(lambda key: F.col(key).cast("bigint") % 10 == 1))
    # Stored, as each load of a warehouse is: two merges read it, and neither computes it again.
    later = stored(load(lambda key: F.col(key).cast("bigint") % 5 != 0), "sales-lines")
    keys = facts.FACT_KEYS["fact_sales"]
    table.write(merge.replace_rows(table.read(), later, keys))
    table.vacuum(keep=1)
    # The first merge has checked that these rows have one row per key.
    return merge.replace_rows(table.read(), later, keys, unique=True).select(*facts.SALES_COLUMNS)


# --- joins ---


@query
def join_inner(s: Source) -> DataFrame:
    lines = facts.order_lines(s.clean("order_items"))
    orders = s.clean("orders").select("order_id", "customer_id", "order_status")
    return lines.join(orders, "order_id")


@query
def join_left(s: Source) -> DataFrame:
    """Orders with their payments, if any."""
    return s.clean("orders").select("order_id", "order_status").join(
        facts.order_payments(s.clean("order_payments")), "order_id", "left"
    )


@query
def join_left_expr(s: Source) -> DataFrame:
    orders = s.clean("orders").select("order_id", date_key(_PURCHASE).alias("purchase_time_key"))
    calendar = s.stored("dim_time")
    return orders.join(
        calendar, orders["purchase_time_key"] == calendar["time_key"], "left"
    ).select("order_id", "purchase_time_key", "full_date", "day_of_week")


@query
def join_asof_scd2(s: Source) -> DataFrame:
    orders = s.clean("orders").select("order_id", "customer_id", _PURCHASE)
    return scd.asof_join(
        orders,
        s.stored("dim_customer"),
        {"customer_id": "customer_id"},
        _PURCHASE,
        ["customer_key", "city_key", "is_current"],
    )


@query
def join_asof_many_versions(s: Source) -> DataFrame:
    """Lines with the highest order of the supplier's nation on the last day it had one, if that
    is three days ago at most: some hundred versions a nation."""
    nations = s.table("customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    days = s.table("orders").join(nations, F.col("o_custkey") == F.col("c_custkey"))
    days = days.groupBy("nation", F.col("o_orderdate").alias("effective_date")).agg(
        F.max("o_totalprice").alias("highest"), F.count(F.lit(1)).alias("orders")
    )
    after = F.lead("effective_date").over(Window.partitionBy("nation").orderBy("effective_date"))
    late = F.col("effective_date") + F.expr("INTERVAL 3 DAYS")
    versions = days.withColumn("expiry_date", F.least(after, late))
    lines = s.table("lineitem").join(
        s.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey"
    )
    lines = lines.select("l_orderkey", "l_linenumber", "l_partkey", "s_nationkey", "l_shipdate")
    return scd.asof_join(
        lines, versions, {"s_nationkey": "nation"}, "l_shipdate", ["highest", "orders"], plan="carry"
    )


@query
def join_left_anti(s: Source) -> DataFrame:
    """Orders without lines."""
    return s.clean("orders").join(s.order_items().select("order_id"), "order_id", "left_anti")


# Widths in shuffles of the star join; what does not fit is carried as it is.
_STAR_BITS = {"full_date": 18, "quantity": 11, "seller": 19, "customer_city_key": 14}


@query
def join_star(s: Source) -> DataFrame:
    t = _stored(s, *_STAR)
    keys = ("product_key", "customer_key", "seller_key")
    lines = t["fact_sales"].select("order_id", *keys, "purchase_time_key", "quantity").withColumns({k: packed_key(k) for k in keys})
    dates = t["dim_time"].select(F.col("time_key").alias("purchase_time_key"), "full_date")
    lines = lines.join(dates, "purchase_time_key", "left").drop("purchase_time_key")
    names = t["dim_product_category"].select("category_key", "category_name_en")
    cities = {n: t[f"dim_{n}"].select(f"{n}_key", F.col("city_key").alias(f"{n}_city_key")) for n in ("customer", "seller")}
    categories = t["dim_product"].select("product_key", "category_key").join(names, "category_key", "left")
    # Where lines are shuffled, they carry numbers of sellers and cities; unknown sellers keep their key.
    wide = not all(fits_broadcast(t[n]) for n in ("dim_customer", "dim_product"))
    sellers = places = None
    if wide:
        lines = lines.withColumn("order_id", packed_number("order_id"))
        known = t["dim_seller"].select("seller_key", packed_key("seller_key").alias("seller")).distinct()
        known, sellers = scd.numbered_values(known, "seller")
        cities["customer"], places = scd.numbered_values(cities["customer"], "customer_city_key")
    if sellers is not None:
        lines = scd.join_versions(lines, known, "seller_key", ["seller"])
        lines = lines.withColumn("seller_key", F.when(F.col("seller").isNull(), F.col("seller_key")))
    # Customers before products: after their shuffle, their key is not carried any further. Sellers last.
    for key, side, take in (
        ("customer_key", cities["customer"], "customer_city_key"),
        ("product_key", categories, "category_name_en"),
    ):
        bits = {c: width for c, width in _STAR_BITS.items() if c in lines.columns}
        if wide:
            lines = pack(lines, bits, "_packed")
        lines = scd.join_versions(lines, side, key, [take])
        if wide:
            lines = unpack(lines, bits, "_packed")
        lines = lines.drop("customer_key")
    lines = scd.named_values(lines, "customer_city_key", places)
    if sellers is not None:
        lines = scd.named_values(lines, "seller", sellers).withColumn("seller_key", F.coalesce("seller", "seller_key"))
    lines = scd.join_versions(lines, cities["seller"], "seller_key", ["seller_city_key"])
    return lines.select(
        unpacked_number("order_id").alias("order_id") if wide else F.col("order_id"),
        unpacked_key("product_key").alias("product_key"),
        unpacked_key("seller_key").alias("seller_key"),
        "quantity",
        "full_date",
        "category_name_en",
        "customer_city_key",
        "seller_city_key",
    )


@query
def join_preaggregated(s: Source) -> DataFrame:
    """Reviews with the first product of their order."""
    reviews = s.clean("order_reviews").select("review_id", "order_id", "review_score")
    return reviews.join(facts.first_products(s.clean("order_items")), "order_id", "left")


# --- aggregation ---


@query
def agg_order_lines(s: Source) -> DataFrame:
    return facts.order_lines(s.clean("order_items"))


@query
def agg_payments(s: Source) -> DataFrame:
    return facts.order_payments(s.clean("order_payments"))


@query
def agg_first_product(s: Source) -> DataFrame:
    return facts.first_products(s.clean("order_items"))


@query
def agg_conditional_rate(s: Source) -> DataFrame:
    return s.clean("order_payments").groupBy("payment_type").agg(
        rate(F.col("payment_installments") > 6).alias("long_rate"),
        exact_mean("payment_installments").alias("avg_installments"),
    )


@query
def agg_count_star(s: Source) -> DataFrame:
    orders = s.clean("orders")
    return orders.groupBy("order_status", F.year(_PURCHASE).alias("year")).agg(
        F.count(F.lit(1)).alias("orders")
    )


@query
def agg_order_features(s: Source) -> DataFrame:
    return features.order_sums(s.stored("fact_sales"))


@query
def agg_global_max(s: Source) -> DataFrame:
    return s.clean("orders").agg(
        F.max(date_key(_PURCHASE)).alias("max_key"), F.max(_PURCHASE).alias("max_time")
    )


@query
def agg_feature_means(s: Source) -> DataFrame:
    means = scoring.feature_means(_training_features(s))
    return means.select(*[F.round(c, 6).alias(c) for c in means.columns])


@query
def agg_class_counts(s: Source) -> DataFrame:
    return _training_features(s).groupBy("label").agg(F.count(F.lit(1)).alias("rows"))


@query
def agg_confusion_matrix(s: Source) -> DataFrame:
    return evaluation.confusion_counts(_given_scores(s))


@query
def union_all(s: Source) -> DataFrame:
    """The two parts of the split, put together again."""
    train, test = model.split(_kept_features(s))
    return train.unionByName(test).select("order_id", "review_score", "label")


# --- scalar functions ---


@query
def scalar_strings(s: Source) -> DataFrame:
    city = F.trim("customer_city")
    return s.customers().select(
        "customer_id",
        city.alias("trimmed"),
        F.lower(city).alias("lowered"),
        F.upper(F.trim("customer_state")).alias("uppered"),
        F.lpad("customer_zip_code_prefix", 5, "0").alias("padded"),
        F.lpad("customer_unique_id", 5, "0").alias("cut"),
        F.concat(F.col("customer_id"), F.lit("/"), city).alias("joined"),
    )


@query
def scalar_dates(s: Source) -> DataFrame:
    delivered, due = "order_delivered_customer_date", "order_estimated_delivery_date"
    return (
        s.clean("orders")
        .select(
            "order_id",
            F.date_format(_PURCHASE, "yyyyMMdd").alias("day_text"),
            date_key(_PURCHASE).alias("time_key"),
            F.year(_PURCHASE).alias("year"),
            F.quarter(_PURCHASE).alias("quarter"),
            F.month(_PURCHASE).alias("month"),
            F.dayofmonth(_PURCHASE).alias("day"),
            F.date_format(_PURCHASE, "E").alias("day_of_week"),
            F.datediff(delivered, due).alias("delay_days"),
        )
        .withColumn("day_again", key_date("time_key"))
    )


@query
def scalar_hash_keys(s: Source) -> DataFrame:
    return s.clean("order_items").select(
        "order_id",
        "product_id",
        "seller_id",
        hash_key("order_id").alias("shipment_key"),
        F.md5(F.concat("product_id", F.lit("|"), "seller_id")).alias("pair_key"),
    )


@query
def scalar_null_handling(s: Source) -> DataFrame:
    return s.order_payments().select(
        "id",
        F.coalesce("payment_installments", F.lit(1)).alias("filled"),
        F.when(F.col("payment_type") == "Voucher", 1).otherwise(0).alias("is_voucher"),
        F.col("payment_type").isin("Voucher", " boleto").alias("is_listed"),
        ratio(F.col("payment_value"), F.col("payment_installments") - 1).alias("per_later_part"),
        F.col("payment_value").isNull().alias("is_missing"),
    )


@query
def scalar_json(s: Source) -> DataFrame:
    return s.table("events").select(
        "event_id", F.from_json("props", "k BIGINT").getField("k").alias("k")
    )


@query
def scalar_arrays_sequence(s: Source) -> DataFrame:
    """Orders under way on each day between purchase and delivery."""
    days = F.sequence(
        F.col(_PURCHASE).cast("date"),
        F.col("order_delivered_customer_date").cast("date"),
        F.make_dt_interval(days=F.lit(1)),
    )
    return (
        s.clean("orders")
        .select(F.explode(days).alias("day"))
        .groupBy("day")
        .agg(F.count(F.lit(1)).alias("under_way"))
    )


# --- dimensions ---


@query
def dim_customer(s: Source) -> DataFrame:
    return s.versioned("dim_customer")


@query
def dim_product(s: Source) -> DataFrame:
    return s.versioned("dim_product")


@query
def dim_seller(s: Source) -> DataFrame:
    return s.versioned("dim_seller")


@query
def dim_geolocation(s: Source) -> DataFrame:
    return dims.dim_geolocation(s.clean("geolocation"))


@query
def dim_product_category(s: Source) -> DataFrame:
    return dims.dim_product_category(s.clean("product_category_name_translation"))


@query
def dim_status(s: Source) -> DataFrame:
    return dims.dim_status(s.clean("orders"))


@query
def dim_payment_type(s: Source) -> DataFrame:
    return dims.dim_payment_type(s.clean("order_payments"))


@query
def dim_time(s: Source) -> DataFrame:
    return s.dim_time()


# --- facts ---


@query
def fact_sales(s: Source) -> DataFrame:
    return s.fact("fact_sales")


@query
def fact_payments(s: Source) -> DataFrame:
    return s.fact("fact_payments")


@query
def fact_reviews(s: Source) -> DataFrame:
    return s.fact("fact_reviews")


@query
def fact_shipment(s: Source) -> DataFrame:
    return s.fact("fact_shipment")


# --- marts ---


_STAR = (
    "fact_sales",
    "dim_product",
    "dim_customer",
    "dim_seller",
    "dim_time",
    "dim_product_category",
)


def _stored(s: Source, *names: str) -> dict[str, DataFrame]:
    return {name: s.stored(name) for name in names}


@query
def revenue_mart(s: Source) -> DataFrame:
    return marts.build_mart("revenue_mart", _stored(s, *_STAR))


@query
def cashflow_mart(s: Source) -> DataFrame:
    tables = _stored(s, "fact_payments", "dim_payment_type", "dim_time")
    return marts.build_mart("cashflow_mart", tables)


@query
def customer_experience_mart(s: Source) -> DataFrame:
    return marts.build_mart("customer_experience_mart", _stored(s, "fact_reviews", *_STAR))


@query
def logistics_mart(s: Source) -> DataFrame:
    return marts.build_mart("logistics_mart", _stored(s, "fact_shipment", *_STAR))


@query
def customer_experience_mart_v2(s: Source) -> DataFrame:
    return marts.build_mart("customer_experience_mart_v2", _stored(s, "fact_reviews", "fact_shipment", *_STAR))


@query
def logistics_mart_v2(s: Source) -> DataFrame:
    return marts.build_mart("logistics_mart_v2", _stored(s, "fact_shipment", *_STAR))


# --- features, training, scoring ---


def _training_features(s: Source) -> DataFrame:
    return features.training_features(s.stored("fact_sales"), s.stored("fact_reviews"))


def _kept_features(s: Source) -> DataFrame:
    """The same, stored: for queries that read them in several jobs."""
    return stored(_training_features(s), "training-features")


def _given_scores(s: Source) -> DataFrame:
    """A stand-in for model scores that SQL can repeat."""
    return _training_features(s).withColumn(
        "score", ratio(F.col("delivery_time") % 20, F.lit(20))
    )


@query
def ml_features(s: Source) -> DataFrame:
    return _training_features(s)


@query
def scoring_features(s: Source) -> DataFrame:
    return features.scoring_features(s.stored("fact_sales"))


@query
def ml_class_weights(s: Source) -> DataFrame:
    return model.class_weights(_training_features(s))


@query
def ml_stratified_split(s: Source) -> DataFrame:
    return _training_features(s).select(
        "order_id", "review_score", "label", model.is_test_row().alias("is_test")
    )


@query
def ml_threshold_search(s: Source) -> DataFrame:
    return evaluation.threshold_scores(_given_scores(s), CANDIDATE_THRESHOLDS)


@query
def ml_classification_report(s: Source) -> DataFrame:
    return evaluation.classification_report(_given_scores(s), 0.55)


@query
def ml_mean_impute(s: Source) -> DataFrame:
    filled = scoring.impute_means(
        features.scoring_features(s.stored("fact_sales")), _training_features(s)
    )
    return filled.select(
        "order_id", *[F.round(c, 6).alias(c) for c in features.FEATURES]
    )


@query
def ml_roc_auc(s: Source) -> DataFrame:
    return evaluation.roc_auc(_given_scores(s))


def _stored_weights(s: Source) -> Weights:
    """A model that was saved as a table, read back."""
    path = shared_dir(s.spark, "weights")
    Weights(*zip(*REVIEW_WEIGHTS, strict=True), REVIEW_INTERCEPT).save(s.spark, path)
    return Weights.read(s.spark, path)


@query
def ml_predict_stored(s: Source) -> DataFrame:
    """The test part, scored by a stored model."""
    _, test = model.split(model.complete_rows(_training_features(s)))
    scored = _stored_weights(s).predict(test)
    return scored.select("order_id", "label", F.round("score", 9).alias("score"), "prediction")


@query
def ml_report_stored(s: Source) -> DataFrame:
    """Report and ROC area of a stored model over its test part."""
    _, test = model.split(model.complete_rows(_training_features(s)))
    scored = _stored_weights(s).predict(test).select("label", F.round("score", 9).alias("score"))
    # Two numbers a row are stored; the area and the report read them, and no feature is made twice.
    scored = stored(scored, "scored")
    area = evaluation.roc_auc(scored).select("roc_auc").scalar()
    return evaluation.classification_report(scored, 0.5).select("*", area.alias("roc_auc"))


@query
def score_new_orders_stored(s: Source) -> DataFrame:
    """``score_new_orders`` with a stored model."""
    sales, training = s.stored("fact_sales"), _kept_features(s)
    alerts_path, weights = shared_dir(s.spark, "alerts"), _stored_weights(s)
    early = sales.where("purchase_time_key <= 20001231")
    first = scoring.score_new_orders(early, training, weights, None, "2001-01-01 06:00:00", 0.5)
    first.write.mode("append").parquet(alerts_path)
    held = s.spark.read.parquet(alerts_path)
    second = scoring.score_new_orders(sales, training, weights, held, "2001-08-02 06:00:00", 0.5)
    second.write.mode("append").parquet(alerts_path)
    return s.spark.read.parquet(alerts_path).withColumn("score", F.round("score", 6))


def _canceled_alerts(s: Source, sales: DataFrame) -> DataFrame:
    """Alerts of an earlier run: canceled orders up to mid-2000."""
    return sales.where("is_canceled = 1 AND purchase_time_key <= 20000630").select(
        "order_id", "purchase_time_key"
    )


@query
def scoring_candidates(s: Source) -> DataFrame:
    sales = s.stored("fact_sales")
    return scoring.scoring_candidates(sales, _canceled_alerts(s, sales))


@query
def ml_train_predict(s: Source) -> DataFrame:
    _, predictions = model.train(_kept_features(s), shared_dir(s.spark, "model"))
    return predictions.select("order_id", "label", "score", "prediction")


@query
def ml_model_report(s: Source) -> DataFrame:
    """Report of a trained model at its chosen threshold, with the area under the ROC curve."""
    _, predictions = model.train(_kept_features(s), shared_dir(s.spark, "model"))
    threshold, _ = evaluation.best_threshold(predictions)
    return evaluation.classification_report(predictions, threshold).select(
        "*",
        F.lit(threshold).alias("threshold"),
        F.lit(model.roc_auc(predictions)).alias("roc_auc"),
    )


@query
def score_new_orders(s: Source) -> DataFrame:
    """A first run up to the end of 2000 and a second one over all sales, with a saved model."""
    sales, training = s.stored("fact_sales"), _kept_features(s)
    fitted, _ = model.train(training, shared_dir(s.spark, "model"))

    alerts_path = shared_dir(s.spark, "alerts")
    early = sales.where("purchase_time_key <= 20001231")
    first = scoring.score_new_orders(early, training, fitted, None, "2001-01-01 06:00:00")
    first.write.mode("append").parquet(alerts_path)
    held = s.spark.read.parquet(alerts_path)
    second = scoring.score_new_orders(sales, training, fitted, held, "2001-08-02 06:00:00")
    second.write.mode("append").parquet(alerts_path)
    return s.spark.read.parquet(alerts_path)


# --- insights ---


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n).cast("double"), 6) for n in names})


@query
def customer_lifetime_value(s: Source) -> DataFrame:
    history = insights.customer_history(insights.purchases(s.stored("fact_sales")), "2001-08-31")
    values = insights.lifetime_value(history)
    return _rounded(values, "expected_purchases", "expected_each", "lifetime_value")


@query
def product_popularity(s: Source) -> DataFrame:
    """In two loads: a state at the end of 1999, and the sales after it."""
    sales = s.stored("fact_sales")
    early, late = sales.where("purchase_time_key <= 19991231"), sales.where("purchase_time_key > 19991231")
    state = insights.popularity_of(early, "1999-12-31")
    path = shared_dir(s.spark, "popularity")
    state.write.parquet(path)
    now = insights.advance_popularity(s.spark.read.parquet(path), "1999-12-31", late, "2001-08-31")
    return _rounded(now, "popularity")


@query
def seller_reputation(s: Source) -> DataFrame:
    t = _stored(s, "fact_sales", "fact_reviews", "dim_product")
    scores = insights.seller_scores(t["fact_sales"], t["fact_reviews"], t["dim_product"])
    names = ("mean_score", "category_mean", "own_weight", "reputation")
    return _rounded(insights.seller_reputation(scores), *names)


# --- catalog ---


def _by_order(s: Source) -> dict[str, DataFrame]:
    """Cleaned entities as catalog tables, bucketed by order."""
    rows = {n: s.clean(n) for n in ("orders", "order_items", "order_payments")}
    own, buckets = uuid.uuid4().hex[:12], catalog.buckets_for(*rows.values())
    return {
        n: catalog.save_bucketed(df, "default", f"{n}_{own}", ["order_id"], buckets, shared_dir(s.spark, n))
        for n, df in rows.items()
    }


@query
def catalog_payments_by_order(s: Source) -> DataFrame:
    """fact_payments from bucketed catalog tables."""
    tables = _by_order(s)
    return facts.fact_payments(tables["orders"], tables["order_payments"])


@query
def catalog_lines_by_order(s: Source) -> DataFrame:
    """Lines of each order, grouped and joined to it, from bucketed catalog tables."""
    tables = _by_order(s)
    orders = tables["orders"].select("order_id", "customer_id", "order_status")
    lines = facts.order_lines(tables["order_items"])
    return lines.join(orders, "order_id")


# --- change feed and streaming ---


@query
def cdc_envelope_parse(s: Source) -> DataFrame:
    return feed.parse_envelope(s.change_feed(), carry=["seq"])


@query
def cdc_bronze_partitions(s: Source) -> DataFrame:
    """Landing columns, with the time of the change standing in for the clock."""
    changes = _user_changes(s)
    clock = F.timestamp_millis("ts_ms").cast("timestamp_ntz")
    return feed.with_processing_date(changes, clock).select(
        "seq", "op", "processing_time", "year", "month", "day"
    )


def _as_files(s: Source, rows: DataFrame, name: str) -> str:
    """Write a feed as about as many files as the session's width, which follows the input's size.

    Tasks cut their files by row numbers: the messages are not shuffled for that.
    """
    path = shared_dir(s.spark, name)
    files = int(s.spark.conf.get("spark.sql.shuffle.partitions"))
    most = max(1, -(-rows.count() // files))
    rows.write.option("maxRecordsPerFile", most).option("compression", "zstd").parquet(path)
    return path


def _file_feed(s: Source, path: str) -> DataFrame:
    """A stream over the files in about three batches, whatever their size."""
    third = max(1, plan_bytes(s.spark.read.parquet(path)) // 3)
    return feed.file_feed(s.spark, path, max_bytes=third)


def _clock():
    return F.lit("2024-02-01 03:04:05").cast("timestamp_ntz")


def _landed(s: Source, rows: DataFrame, name: str) -> str:
    """Land a feed in bronze and return the folder. The feed's own files, which stand for a topic, go when
    both queries have drained them."""
    root = shared_dir(s.spark, name)
    files = _as_files(s, rows, f"{name}-feed")
    stream = _file_feed(s, files)
    options = {"carry": ["seq"], "processing_time": _clock(), "trigger": feed.DRAIN}
    feed.finish(*feed.land_topics({name: stream}, root, **options).values())
    delete_path(s.spark, files)
    return f"{root}/bronze/{name}"


@query
def stream_bronze_append(s: Source) -> DataFrame:
    return s.spark.read.parquet(_landed(s, s.change_feed(), "users"))


@query
def stream_rejects(s: Source) -> DataFrame:
    """A feed with tombstones, broken messages and broken records: what became of every message."""
    kind = F.col("seq") % 7
    broken = '{"payload": {"after": "{user", "op": "u", "source": {"ts_ms": 1}}}'
    value = F.when(kind == 1, F.lit("{payload")).when(kind == 2, F.lit(broken)).when(kind != 0, F.col("value"))
    path = _landed(s, s.change_feed().withColumn("value", value), "mixed")
    landed = s.spark.read.parquet(path)
    lost = silver.unreadable_changes(landed, "user_id bigint, event_type string", ["user_id"])
    parts = {
        "accepted": landed.join(lost.select("seq"), "seq", "left_anti"),
        "unreadable": lost,
        "rejected": s.spark.read.parquet(path.replace("/bronze/", "/rejects/")),
    }
    return reduce(DataFrame.union, [rows.select("seq", F.lit(k).alias("outcome")) for k, rows in parts.items()])


@query
def stream_two_topics(s: Source) -> DataFrame:
    root = shared_dir(s.spark, "topics")
    feeds = {
        "orders": _file_feed(s, _as_files(s, s.order_feed(), "orders-feed")),
        "order_items": _file_feed(s, _as_files(s, s.order_item_feed(), "items-feed")),
    }
    options = {"carry": ["seq"], "processing_time": _clock(), "trigger": feed.DRAIN}
    feed.finish(*feed.land_topics(feeds, root, **options).values())
    parts = [
        s.spark.read.parquet(f"{root}/bronze/{name}").select(F.lit(name).alias("topic"), "op", "ts_ms")
        for name in feeds
    ]
    return (
        parts[0]
        .unionByName(parts[1])
        .groupBy("topic", "op")
        .agg(
            F.count(F.lit(1)).alias("changes"),
            F.min("ts_ms").alias("oldest_ms"),
            F.max("ts_ms").alias("newest_ms"),
        )
    )


@query
def stream_silver_upsert(s: Source) -> DataFrame:
    root = shared_dir(s.spark, "reviews")
    stream = _file_feed(s, _as_files(s, s.order_reviews(), "reviews-bronze"))
    feed.finish(
        silver.merge_row_stream(
            stream,
            f"{root}/silver",
            f"{root}/checkpoint",
            ["review_id", "order_id"],
            "last_modified_date",
            "order_reviews",
        )
    )
    return silver.open_table(s.spark, f"{root}/silver", ["review_id", "order_id"]).read()


def _drain_items(s: Source, bronze: str, root: str) -> PartitionedTable:
    keys = ["order_id", "order_item_id"]
    feed.finish(
        silver.merge_change_stream(
            _file_feed(s, bronze),
            f"{root}/silver",
            f"{root}/checkpoint",
            keys,
            CHANGE_RECORD_DDL["order_items"],
            "order_items",
            sequence="seq",
        )
    )
    return silver.open_table(s.spark, f"{root}/silver", keys)


@query
def stream_cdc_apply(s: Source) -> DataFrame:
    bronze = _landed(s, s.order_item_feed(), "order_items")
    return _drain_items(s, bronze, shared_dir(s.spark, "items")).read()


@query
def stream_restart_idempotent(s: Source) -> DataFrame:
    """A second run on the same checkpoint finds nothing new."""
    root = shared_dir(s.spark, "users")
    bronze = _landed(s, s.change_feed(), "users")
    for _ in range(2):
        feed.finish(
            silver.merge_change_stream(
                _file_feed(s, bronze),
                f"{root}/silver",
                f"{root}/checkpoint",
                ["user_id"],
                USER_DDL,
                sequence="seq",
            )
        )
    return silver.open_table(s.spark, f"{root}/silver", ["user_id"]).read()
