"""The source entities, reshaped from the supplied test tables.

Whole tables throughout. NULLs, stray blanks and mixed case are put in by
expressions, because the supplied tables have none; batches that follow the
first one add and drop customers by market segment, suppliers and parts by an
attribute.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.cleaning import MONEY, clean
from millrace.operators.scd import scd2_apply, scd2_initial
from millrace.plans import dimensions as dims
from millrace.plans.warehouse import FACTS, REPLACED, VERSIONED, Warehouse
from millrace.session import configure, shared_dir

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Processing time of the second batch; orders fall on both sides of it.
SECOND_LOAD = "1998-01-01 00:00:00"


# Folder of the stored dimensions and facts, by application and test tables.
_warehouses: dict[tuple[str, str], str] = {}


def text(column: str) -> Column:
    return F.col(column).cast("string")


def days(n: Column) -> Column:
    return F.make_dt_interval(days=n.cast("int"))


def epoch_ms(column: Column) -> Column:
    """Epoch milliseconds, as text, of a timestamp without zone (session zone UTC)."""
    return F.unix_millis(column.cast("timestamp")).cast("string")


def envelope(record: Column, op: Column, ts_ms: Column) -> Column:
    """Change message: the record is in ``before`` for a delete, in ``after`` otherwise."""
    gone = op == "d"
    payload = F.struct(
        F.when(gone, record).alias("before"),
        F.when(~gone, record).alias("after"),
        op.alias("op"),
        F.struct(ts_ms.alias("ts_ms")).alias("source"),
    )
    return F.to_json(F.struct(payload.alias("payload")))


def once(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Build each view of a source once: a view used twice in a plan is one subtree to Spark."""

    @wraps(build)
    def cached(self, *args):
        key = (build.__name__, *args)
        if key not in self.built:
            self.built[key] = build(self, *args)
        return self.built[key]

    return cached


class Source:
    """Lazy views over one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.built: dict[tuple, DataFrame] = {}
        configure(spark, [self.table("lineitem"), self.table("orders"), self.table("events")])

    @once
    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # --- raw entities, as a source system would deliver them ---

    @once
    def _places(self) -> DataFrame:
        return self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )

    @once
    def _customer_places(self) -> DataFrame:
        return self.table("customer").join(
            self._places(), F.col("c_nationkey") == F.col("n_nationkey")
        )

    @once
    def _supplier_places(self) -> DataFrame:
        return self.table("supplier").join(
            self._places(), F.col("s_nationkey") == F.col("n_nationkey")
        )

    def customers(self) -> DataFrame:
        key = F.col("c_custkey")
        return self._customer_places().select(
            text("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_unique_id"),
            text("c_nationkey").alias("customer_zip_code_prefix"),
            F.when(key % 50 != 0, F.concat(F.lit("  "), "n_name", F.lit(" "))).alias(
                "customer_city"
            ),
            F.when(key % 75 != 0, F.lower("r_name")).alias("customer_state"),
        )

    def customers_next(self) -> DataFrame:
        """Second batch: moves, lost zip codes, new customers; one segment is absent."""
        key = F.col("c_custkey")
        moved = (F.col("c_nationkey") + F.when(key % 10 == 0, 1).otherwise(0)) % 25
        zip_code = F.when(key % 7 != 0, moved.cast("string"))
        rows = self._customer_places()

        def shaped(df: DataFrame, identity: Column) -> DataFrame:
            return df.select(
                identity.alias("customer_id"),
                F.col("c_name").alias("customer_unique_id"),
                zip_code.alias("customer_zip_code_prefix"),
                F.col("n_name").alias("customer_city"),
                F.col("r_name").alias("customer_state"),
            )

        kept = shaped(rows.where("c_mktsegment <> 'MACHINERY'"), text("c_custkey"))
        added = shaped(
            rows.where("c_mktsegment = 'BUILDING'"), F.concat(F.lit("N"), text("c_custkey"))
        )
        return kept.unionByName(added)

    def sellers(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self._supplier_places().select(
            text("s_suppkey").alias("seller_id"),
            text("s_nationkey").alias("seller_zip_code_prefix"),
            F.when(key % 20 != 0, F.concat(F.lit(" "), "n_name", F.lit("  "))).alias("seller_city"),
            F.when(key % 30 != 0, F.lower("r_name")).alias("seller_state"),
        )

    def sellers_next(self) -> DataFrame:
        moved = (F.col("s_nationkey") + F.when(F.col("s_suppkey") % 4 == 0, 1).otherwise(0)) % 25
        return self._supplier_places().select(
            text("s_suppkey").alias("seller_id"),
            moved.cast("string").alias("seller_zip_code_prefix"),
            F.col("n_name").alias("seller_city"),
            F.col("r_name").alias("seller_state"),
        )

    def products(self) -> DataFrame:
        return self._products(text("p_size"))

    def products_next(self) -> DataFrame:
        """Second batch: a tenth of the products weighs more."""
        heavier = F.col("p_size") + F.when(F.col("p_partkey") % 10 == 0, 1).otherwise(0)
        return self._products(heavier.cast("string"))

    def _products(self, weight: Column) -> DataFrame:
        key = F.col("p_partkey")
        return self.table("part").select(
            text("p_partkey").alias("product_id"),
            F.concat(F.lit(" "), "p_type").alias("product_category_name"),
            F.length("p_name").alias("product_name_lenght"),
            F.length("p_brand").alias("product_description_lenght"),
            F.when(key % 60 == 0, "several").otherwise((key % 6).cast("string")).alias(
                "product_photos_qty"
            ),
            weight.alias("product_weight_g"),
            F.when(key % 40 != 0, text("p_size")).alias("product_length_cm"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("product_height_cm"),
            (F.col("p_size") * 2).cast("string").alias("product_width_cm"),
        )

    def product_category_name_translation(self) -> DataFrame:
        return self.table("part").select(
            F.concat(F.lit(" "), "p_type").alias("product_category_name"),
            F.concat(F.lower("p_type"), F.lit("  ")).alias("product_category_name_english"),
        ).distinct()

    def geolocation(self) -> DataFrame:
        """Every zip code twice, at two positions: one per customer side and supplier side."""
        places = self._places()

        def at(side: Column) -> DataFrame:
            return places.select(
                text("n_nationkey").alias("geolocation_zip_code_prefix"),
                (F.col("n_nationkey") * 3 - 40 + side).cast("decimal(10,8)").alias(
                    "geolocation_lat"
                ),
                (F.col("n_nationkey") * 5 - 90 - side).cast("decimal(11,8)").alias(
                    "geolocation_lng"
                ),
                F.concat(F.lit(" "), "n_name").alias("geolocation_city"),
                F.lower("r_name").alias("geolocation_state"),
            )

        customers = self.table("customer").select("c_nationkey").distinct()
        suppliers = self.table("supplier").select("s_nationkey").distinct()
        zip_code = F.col("geolocation_zip_code_prefix")
        return (
            at(F.lit(0.25))
            .join(customers, zip_code == text("c_nationkey"), "left_semi")
            .unionByName(
                at(F.lit(0.5)).join(suppliers, zip_code == text("s_nationkey"), "left_semi")
            )
        )

    @once
    def orders(self) -> DataFrame:
        """Typed times; canceled orders (P) are not approved, only F is delivered."""
        status, placed, key = F.col("o_orderstatus"), F.col("o_orderdate"), F.col("o_orderkey")
        delivered = status == "F"
        return self.table("orders").select(
            text("o_orderkey").alias("order_id"),
            text("o_custkey").alias("customer_id"),
            F.when(delivered, " Delivered")
            .when(status == "P", "CANCELED")
            .otherwise("created ")
            .alias("order_status"),
            placed.alias("order_purchase_timestamp"),
            F.when(status != "P", placed + days(F.lit(1))).alias("order_approved_at"),
            F.when(delivered, placed + days(2 + key % 5)).alias("order_delivered_carrier_date"),
            F.when(delivered, placed + days(4 + key % 29)).alias("order_delivered_customer_date"),
            (placed + days(15 + F.col("o_custkey") % 10)).alias("order_estimated_delivery_date"),
        )

    def orders_feed_rows(self) -> DataFrame:
        """Orders as change records carry them: times are epoch milliseconds in text."""
        return self.orders().select(
            "order_id",
            "customer_id",
            "order_status",
            *[
                epoch_ms(F.col(c)).alias(c)
                for c in (
                    "order_purchase_timestamp",
                    "order_approved_at",
                    "order_delivered_carrier_date",
                    "order_delivered_customer_date",
                    "order_estimated_delivery_date",
                )
            ],
        )

    @once
    def order_items(self) -> DataFrame:
        price = F.col("l_extendedprice").cast(MONEY)
        return self.table("lineitem").select(
            text("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            text("l_partkey").alias("product_id"),
            text("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            price.alias("price"),
            F.round(price * F.col("l_tax").cast("decimal(4,2)"), 2).cast(MONEY).alias(
                "freight_value"
            ),
        )

    def order_items_feed_rows(self) -> DataFrame:
        """Lines as change records carry them: all text, some measures missing or malformed."""
        part, supplier = F.col("l_partkey"), F.col("l_suppkey")
        price = F.col("l_extendedprice").cast(MONEY)
        freight = F.round(price * F.col("l_tax").cast("decimal(4,2)"), 2).cast(MONEY)
        return self.table("lineitem").select(
            text("l_orderkey").alias("order_id"),
            text("l_linenumber").alias("order_item_id"),
            text("l_partkey").alias("product_id"),
            text("l_suppkey").alias("seller_id"),
            epoch_ms(F.col("l_shipdate")).alias("shipping_limit_date"),
            F.when(part % 50 == 0, "n/a").otherwise(price.cast("string")).alias("price"),
            F.when(supplier % 25 != 0, freight.cast("string")).alias("freight_value"),
        )

    def order_payments(self) -> DataFrame:
        value = F.round(
            F.col("l_extendedprice").cast(MONEY)
            * (1 - F.col("l_discount").cast("decimal(4,2)")),
            2,
        )
        flag = F.col("l_returnflag")
        return self.table("lineitem").select(
            F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("id"),
            text("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("payment_sequential"),
            F.when(flag == "R", "Voucher")
            .when(flag == "A", " boleto")
            .otherwise("Credit_Card")
            .alias("payment_type"),
            F.when(F.col("l_partkey") % 40 != 0, 1 + F.col("l_partkey") % 12).alias(
                "payment_installments"
            ),
            F.when(F.col("l_suppkey") % 30 != 0, value.cast(MONEY)).alias("payment_value"),
            F.col("l_shipdate").alias("last_modified_date"),
        )

    def order_reviews(self) -> DataFrame:
        """Reviews spread over the years before 2024; some dates are implausible."""
        key, ts = F.col("event_id"), F.col("ts")
        shift = (
            F.when(key % 97 == 0, F.lit(-10000))
            .when(key % 89 == 0, F.lit(10000))
            .otherwise(-(key % 8000))
        )
        return self.table("events").select(
            F.concat(F.lit(" r"), text("event_id")).alias("review_id"),
            text("event_id").alias("order_id"),
            (1 + F.floor("value") % 5).cast("string").alias("review_score"),
            F.concat(F.lit(" "), "event_type").alias("review_comment_title"),
            F.col("props").alias("review_comment_message"),
            (ts + days(shift)).alias("review_creation_date"),
            F.when(key % 3 != 0, ts + days(shift + 2)).alias("review_answer_timestamp"),
            ts.alias("last_modified_date"),
        )

    def change_feed(self) -> DataFrame:
        """Envelope per event: keyed by user, ``error`` deletes, ``signup`` creates."""
        op = (
            F.when(F.col("event_type") == "error", "d")
            .when(F.col("event_type") == "signup", "c")
            .otherwise("u")
        )
        ts_ms = F.expr("unix_micros(cast(ts AS timestamp)) div 1000")
        record = F.struct("user_id", "event_type")
        return self.table("events").select(
            F.col("event_id").alias("seq"), envelope(record, op, ts_ms).alias("value")
        )

    def order_feed(self) -> DataFrame:
        """Envelope per order; a canceled order is deleted."""
        status = F.col("order_status")
        op = (
            F.when(status == "CANCELED", "d").when(status == "created ", "c").otherwise("u")
        )
        record = F.struct("*")
        ts_ms = F.col("order_purchase_timestamp").cast("bigint")
        return self.orders_feed_rows().select(
            F.col("order_id").cast("bigint").alias("seq"),
            envelope(record, op, ts_ms).alias("value"),
        )

    def order_item_feed(self) -> DataFrame:
        """Envelope per line; lines of one order and number are changes to it, in order of
        shipping date and then ``seq``. A line without freight is a deletion."""
        op = F.when(F.col("freight_value").isNull(), "d").otherwise("u")
        ts_ms = F.col("shipping_limit_date").cast("bigint")
        record = F.struct("*")
        product, seller = F.col("product_id").cast("bigint"), F.col("seller_id").cast("bigint")
        return self.order_items_feed_rows().select(
            (product * 1_000_000_000 + seller).alias("seq"),
            envelope(record, op, ts_ms).alias("value"),
        )

    # --- cleaned entities ---

    @once
    def clean(self, entity: str) -> DataFrame:
        return clean(getattr(self, entity)(), entity)

    @once
    def clean_next(self, entity: str) -> DataFrame:
        return clean(getattr(self, f"{entity}_next")(), entity)

    # --- dimensions after two loads, as plans ---

    def batches(self, dimension: str) -> tuple[DataFrame, DataFrame]:
        """Rows of a versioned dimension's two loads."""
        _, entity, rows_of = VERSIONED[dimension]
        return rows_of(self.clean(entity)), rows_of(self.clean_next(entity))

    def versioned(self, dimension: str) -> DataFrame:
        spec, _, _ = VERSIONED[dimension]
        first, second = self.batches(dimension)
        keys = (spec.business_key, spec.surrogate)
        return scd2_apply(scd2_initial(first, *keys), second, *keys, spec.tracked, SECOND_LOAD)

    def dim_time(self) -> DataFrame:
        """Calendar that holds the dates of all orders and events."""
        dates = (
            self.table("orders")
            .select(F.col("o_orderdate").alias("day"))
            .unionByName(self.table("events").select(F.col("ts").alias("day")))
        )
        return dims.dim_time_covering(dates, "day")

    # --- stored dimensions and facts ---

    def warehouse(self) -> Warehouse:
        """Where this application keeps the warehouse tables of these test tables."""
        key = (self.spark.sparkContext.applicationId, self.folder)
        if key not in _warehouses:
            _warehouses[key] = shared_dir(self.spark, "warehouse")
        return Warehouse(self.spark, _warehouses[key])

    def entities(self) -> dict[str, DataFrame]:
        names = ("orders", "order_items", "order_payments", "order_reviews")
        return {name: self.clean(name) for name in names}

    @once
    def stored(self, name: str) -> DataFrame:
        """A warehouse table; loaded on first use, as the load before this one would have."""
        warehouse = self.warehouse()
        if not warehouse.table("dw_db", name).exists():
            if name in VERSIONED:
                first, second = self.batches(name)
                warehouse.load_versioned(name, first, SECOND_LOAD)
                warehouse.load_versioned(name, second, SECOND_LOAD)
            elif name in FACTS:
                for dimension in VERSIONED:
                    self.stored(dimension)
                warehouse.load_fact(name, self.entities())
            elif name == "dim_time":
                warehouse.replace(name, self.dim_time())
            else:
                entity, build = REPLACED[name]
                warehouse.replace(name, build(self.clean(entity)))
        return warehouse.read(name)

    def fact(self, name: str, **entities: DataFrame) -> DataFrame:
        """A fact computed from the entities and the stored dimensions."""
        for dimension in VERSIONED:
            self.stored(dimension)
        return self.warehouse().fact(name, self.entities() | entities)
