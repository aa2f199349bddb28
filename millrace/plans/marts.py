"""Data marts: aggregates over the star schema.

Two marts join facts of different grain (reviews with sales lines, shipments
with sales lines). Their measures are defined over the joined pairs. Both sides
are first brought to the mart's own keys and aggregated per order, and each
side's sums are weighted with the other side's row count. That gives the same
measures, and an order with very many reviews and lines yields no more joined
rows than the mart has cells for it.

Surrogate keys of facts are shuffled as bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import exact_mean, key_date, pack, packed_key, packed_number, rate, ratio, unpack, unpacked_key
from millrace.operators.scd import join_versions, named_values, numbered_values
from millrace.session import fits_broadcast

Tables = Mapping[str, DataFrame]

# Widths in shuffles of the revenue mart; what does not fit is carried as it is.
_MEASURE_BITS = {"sale_price": 28, "freight_value": 24, "quantity": 11}
_CELL_BITS = {"date": 18, "seller": 19, "customer_geo_key": 14, "product_category": 12}


def _with_city(rows: DataFrame, t: Tables, side: str) -> DataFrame:
    """Replace the packed key of the side, customer or seller, by the city of that version."""
    city = F.col("city_key").alias(f"{side}_geo_key")
    return join_versions(rows, t[f"dim_{side}"], f"{side}_key", [city]).drop(f"{side}_key")


def _packed(fact: DataFrame, *keys: str) -> DataFrame:
    return fact.withColumns({k: packed_key(k) for k in keys})


def _dates(dim_time: DataFrame, fact_key: str) -> DataFrame:
    return dim_time.select(F.col("time_key").alias(fact_key), F.col("full_date").alias("date"))


def _with_category(rows: DataFrame, t: Tables) -> DataFrame:
    """Attach the category name of the product version, whose key is packed.

    Two joins from the fact side, one per stored table: Spark knows the size of
    each, and broadcasts the ones that are small instead of shuffling the fact.
    """
    names = t["dim_product_category"].select(
        "category_key", F.col("category_name_en").alias("product_category")
    )
    rows = join_versions(rows, t["dim_product"], "product_key", ["category_key"]).drop("product_key")
    return rows.join(names, "category_key", "left")


def revenue_mart(t: Tables) -> DataFrame:
    """Lines are shuffled by customer, by product and once by the mart's keys: orders are told apart where
    these bring a cell's lines together. A cell holds a day's lines of one seller at most.

    By customer first, as facts lie by order: an order's lines stay neighbours, whose like values compress."""
    value = F.col("sale_price") + F.col("freight_value")
    sales = t["fact_sales"].select(
        "order_id",
        "customer_key",
        "product_key",
        "seller_key",
        "purchase_time_key",
        "sale_price",
        "quantity",
        "freight_value",
    )
    sales = _packed(sales, "customer_key", "product_key", "seller_key")
    names = t["dim_product_category"].select("category_key", F.col("category_name_en").alias("product_category"))
    sides = {
        "seller": ("seller_key", t["dim_seller"].select("seller_key", packed_key("seller_key").alias("seller"))),
        "customer_geo_key": ("customer_key", t["dim_customer"].select("customer_key", F.col("city_key").alias("customer_geo_key"))),
        "product_category": ("product_key", t["dim_product"].select("product_key", "category_key").join(names, "category_key", "left")),
    }
    # Of a star that Spark broadcasts as it is, lines are shuffled once; numbers would only cost time.
    wide = not all(fits_broadcast(t[n]) for n in ("dim_customer", "dim_product"))
    numbers = {}
    sales = sales.join(_dates(t["dim_time"], "purchase_time_key"), "purchase_time_key", "left").drop("purchase_time_key")
    if wide:
        sales = pack(sales.withColumn("order_id", packed_number("order_id")), _MEASURE_BITS, "_measures")
    known = {}
    for name, (key, side) in sides.items():
        if wide:
            side, numbers[name] = numbered_values(side, name)
            sales = pack(sales, known, "_cell")
        sales = join_versions(sales, side, key, [name]).drop(key)
        if wide:
            sales = unpack(sales, known, "_cell")
            known = {c: _CELL_BITS[c] for c in ("date", *numbers)}
    cells = ["date", *sides]
    if wide:
        sales = pack(sales, known, "_cell")
        cells.append("_cell")
    sales = sales.repartition(*cells)
    mart = (
        (unpack(sales, _MEASURE_BITS, "_measures") if wide else sales)
        .groupBy(*cells)
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.sum(value).alias("total_revenue"),
            exact_mean(value).alias("avg_order_value"),
            F.sum("quantity").alias("total_items_sold"),
            exact_mean("sale_price").alias("avg_price"),
            exact_mean("freight_value").alias("avg_freight_value"),
        )
    )
    measures = [c for c in mart.columns if c not in cells]
    if wide:
        mart = unpack(mart, known, "_cell")
    for name, values in numbers.items():
        mart = named_values(mart, name, values)
    return mart.select(
        "date", "product_category", unpacked_key("seller").alias("seller_key"), "customer_geo_key", *measures
    )


def cashflow_mart(t: Tables) -> DataFrame:
    return (
        t["fact_payments"]
        .join(t["dim_payment_type"], "payment_type_key", "left")
        .join(_dates(t["dim_time"], "time_key"), "time_key", "left")
        .groupBy("date", "payment_type")
        .agg(
            F.sum("Total_payment_value").alias("total_payment_value"),
            exact_mean("Total_payment_value").alias("avg_payment_value"),
            exact_mean("payment_installments").alias("avg_installments"),
            rate(F.col("payment_installments") > 1).alias("installment_ratio"),
            rate(F.col("payment_type") == "voucher").alias("voucher_usage_rate"),
        )
    )


def customer_experience_mart(t: Tables) -> DataFrame:
    score = F.col("Review_score")
    reviews = (
        _with_category(
            t["fact_reviews"].select(
                F.col("Order_id").alias("order_id"), packed_key("product_key").alias("product_key"), "time_key", "Review_score"
            ),
            t,
        )
        .join(_dates(t["dim_time"], "time_key"), "time_key", "left")
        .groupBy("order_id", "date", "product_category")
        .agg(
            F.count(F.lit(1)).alias("reviews"),
            F.sum(score).alias("score"),
            F.count(score).alias("scored"),
            F.count_if(score >= 4).alias("good"),
            F.count_if(score <= 2).alias("bad"),
        )
    )
    sold = _packed(t["fact_sales"].select("order_id", "seller_key", "freight_value", "sale_price"), "seller_key")
    lines = (
        _with_city(sold, t, "seller")
        .groupBy("order_id", "seller_geo_key")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum("freight_value").alias("freight"),
            F.count("freight_value").alias("freights"),
            F.sum("sale_price").alias("price"),
            F.count("sale_price").alias("prices"),
        )
    )
    # A review without sales lines still counts once.
    n_lines, n_reviews = F.coalesce("lines", F.lit(1)), F.col("reviews")
    pairs = n_reviews * n_lines

    def share(counted: str) -> Column:
        return ratio(F.sum(F.col(counted) * n_lines), F.sum(pairs))

    return (
        reviews.join(lines, "order_id", "left")
        .groupBy("date", "product_category", "seller_geo_key")
        .agg(
            ratio(F.sum(F.col("score") * n_lines), F.sum(F.col("scored") * n_lines)).alias(
                "avg_review_score"
            ),
            share("good").alias("good_review_rate"),
            share("bad").alias("bad_review_rate"),
            # Constant by definition of this mart.
            F.lit(0.0).alias("avg_delivery_delay"),
            F.lit(0.0).alias("late_delivery_rate"),
            ratio(F.sum(F.col("freight") * n_reviews), F.sum(F.col("freights") * n_reviews)).alias(
                "avg_freight_value"
            ),
            ratio(F.sum(F.col("price") * n_reviews), F.sum(F.col("prices") * n_reviews)).alias(
                "avg_price"
            ),
            F.sum(pairs).alias("review_volume"),
        )
    )


def logistics_mart(t: Tables) -> DataFrame:
    purchases = (
        t["fact_sales"]
        .groupBy("order_id", "purchase_time_key")
        .agg(F.count(F.lit(1)).alias("lines"))
        .select("order_id", key_date("purchase_time_key").alias("date"), "lines")
    )
    shipments = t["fact_shipment"].select(
        "order_id",
        "customer_key",
        "seller_key",
        key_date("delivered_customer_date").alias("delivered"),
        key_date("estimated_delivery_date").alias("estimated"),
    )
    n_lines = F.coalesce("lines", F.lit(1))
    taken = F.datediff("delivered", "date")
    delay = F.datediff("delivered", "estimated")

    def mean(days: Column) -> Column:
        return ratio(F.sum(days * n_lines), F.sum(F.when(days.isNotNull(), n_lines)))

    def share(condition: Column) -> Column:
        return ratio(F.sum(F.when(condition, n_lines).otherwise(0)), F.sum(n_lines))

    return (
        _with_city(_with_city(_packed(shipments, "customer_key", "seller_key"), t, "seller"), t, "customer")
        .join(purchases, "order_id", "left")
        .groupBy("seller_geo_key", "customer_geo_key", "date")
        .agg(
            mean(taken).alias("avg_delivery_time"),
            mean(delay).alias("avg_delivery_delay"),
            share(delay > 0).alias("late_delivery_rate"),
            share(delay <= 0).alias("on_time_rate"),
            # Both repeat the delivery time by definition of this mart.
            mean(taken).alias("avg_shipping_duration"),
            mean(taken).alias("carrier_to_customer_days"),
            F.sum(n_lines).alias("order_volume"),
        )
    )


def customer_experience_mart_v2(t: Tables) -> DataFrame:
    """Every review once, with the real delay of its order; the seller is that of the shipment."""
    score, delay = F.col("Review_score"), F.col("delivery_delay_days")
    reviews = t["fact_reviews"].select(F.col("Order_id").alias("order_id"), "product_key", "time_key", "Review_score")
    reviews = _with_category(_packed(reviews, "product_key"), t)
    reviews = reviews.join(_dates(t["dim_time"], "time_key"), "time_key", "left")
    shipments = t["fact_shipment"].select("order_id", "seller_key", "delivery_delay_days")
    shipments = _with_city(_packed(shipments, "seller_key"), t, "seller")
    orders = t["fact_sales"].groupBy("order_id").agg(F.sum("freight_value").alias("freight"), F.sum("sale_price").alias("price"))
    return (
        reviews.join(shipments, "order_id", "left")
        .join(orders, "order_id", "left")
        .groupBy("date", "product_category", "seller_geo_key")
        .agg(
            exact_mean(score).alias("avg_review_score"),
            rate(score >= 4).alias("good_review_rate"),
            rate(score <= 2).alias("bad_review_rate"),
            exact_mean(delay).alias("avg_delivery_delay"),
            rate(delay > 0).alias("late_delivery_rate"),
            exact_mean("freight").alias("avg_order_freight"),
            exact_mean("price").alias("avg_order_price"),
            F.count(F.lit(1)).alias("review_volume"),
        )
    )


def logistics_mart_v2(t: Tables) -> DataFrame:
    """Every shipment once, with the days to the carrier and from there to the customer."""
    purchases = t["fact_sales"].groupBy("order_id").agg(key_date(F.min("purchase_time_key")).alias("date"))
    delay = F.col("delivery_delay_days")
    shipments = t["fact_shipment"].select(
        "order_id",
        "customer_key",
        "seller_key",
        "delivered_customer_date",
        "delivered_carrier_date",
        "carrier_to_customer_days",
        "delivery_delay_days",
    )
    return (
        _with_city(_with_city(_packed(shipments, "customer_key", "seller_key"), t, "seller"), t, "customer")
        .join(purchases, "order_id", "left")
        .groupBy("seller_geo_key", "customer_geo_key", "date")
        .agg(
            exact_mean(F.datediff(key_date("delivered_customer_date"), "date")).alias("avg_delivery_time"),
            exact_mean(F.datediff(key_date("delivered_carrier_date"), "date")).alias("avg_days_to_carrier"),
            exact_mean("carrier_to_customer_days").alias("avg_carrier_to_customer_days"),
            exact_mean(delay).alias("avg_delivery_delay"),
            rate(delay > 0).alias("late_delivery_rate"),
            rate(delay <= 0).alias("on_time_rate"),
            F.count(F.lit(1)).alias("order_volume"),
        )
    )


# In build order.
MARTS: dict[str, Callable[[Tables], DataFrame]] = {
    "revenue_mart": revenue_mart,
    "cashflow_mart": cashflow_mart,
    "customer_experience_mart": customer_experience_mart,
    "logistics_mart": logistics_mart,
    "customer_experience_mart_v2": customer_experience_mart_v2,
    "logistics_mart_v2": logistics_mart_v2,
}


def build_mart(name: str, tables: Tables) -> DataFrame:
    if name not in MARTS:
        raise ValueError(f"Unsupported mart table: {name}")
    return MARTS[name](tables)
