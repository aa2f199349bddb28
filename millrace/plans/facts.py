"""Facts of the star schema: cleaned entities joined to the dimension versions valid in time.

Attributes of an order are joined and derived at order grain before the lines
are attached, so the wide, long side is shuffled as few times as possible.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import (
    date_key,
    hash_key,
    pack,
    packed_key,
    packed_number,
    unpack,
    unpacked_key,
    unpacked_number,
    version_key,
)
from millrace.operators.merge import merge_into
from millrace.operators.scd import FIRST_EFFECTIVE, asof_join, listable, valid_keys, valid_surrogate, with_versions

# Natural keys by which a re-run merges each fact. A line of sales is known by what exists before
# any dimension is looked up: its surrogate keys are NULL, or change, when a dimension comes late.
FACT_KEYS = {
    "fact_sales": ("order_id", "product_id", "seller_id"),
    "fact_payments": ("order_id",),
    "fact_reviews": ("Review_id", "Order_id"),
    "fact_shipment": ("shipment_key",),
}


# The columns of fact_sales. The stored fact has the line's product_id and seller_id as well.
SALES_COLUMNS = (
    "order_id",
    "customer_key",
    "product_key",
    "seller_key",
    "purchase_time_key",
    "delivery_time_key",
    "status_key",
    "sale_price",
    "quantity",
    "total_value",
    "is_canceled",
    "delivery_delay_days",
    "freight_value",
)

# Widths in the shuffles of lines; what does not fit is carried as it is.
_LINE_BITS = {"price": 28, "freight_value": 24, "order_item_id": 11}
MERGE_BITS = (
    {"purchase_time_key": 25, "freight_value": 24, "quantity": 11, "is_canceled": 1},
    {"sale_price": 28, "total_value": 34},
)


def _item_number() -> Column:
    """The item number as a number, last where it is none; change feeds deliver it as text."""
    return F.coalesce(F.col("order_item_id").try_cast("int"), F.lit(2**31 - 1))


def _line_values() -> list[Column]:
    """Measures of the lines of one order, product and seller; the price is that of the lowest item number.

    Items of one number are ranked by price. The rank is a single decimal, not a
    struct, which keeps the aggregation hash-based.
    """
    rank = _item_number().cast("decimal(10,0)") * F.lit(10**12).cast("decimal(13,0)") + F.col("price")
    return [
        F.count("order_item_id").alias("quantity"),
        F.min_by("price", rank).alias("sale_price"),
        F.sum("freight_value").alias("freight_value"),
    ]


def order_lines(items: DataFrame) -> DataFrame:
    """One row per order, product and seller."""
    return items.groupBy("order_id", "product_id", "seller_id").agg(*_line_values())


def order_payments(payments: DataFrame) -> DataFrame:
    """One row per order; the primary type is that of the lowest sequence number."""
    return payments.groupBy("order_id").agg(
        F.count("payment_sequential").alias("Num_payment_methods"),
        F.sum("payment_value").alias("Total_payment_value"),
        F.max("payment_installments").alias("payment_installments"),
        F.min_by("payment_type", F.struct("payment_sequential", "id")).alias("primary_payment_type"),
    )


def first_products(items: DataFrame) -> DataFrame:
    """The product of each order's lowest item number."""
    order = F.struct(_item_number().alias("number"), "product_id")
    return items.groupBy("order_id").agg(F.min_by("product_id", order).alias("product_id"))


def first_items(items: DataFrame) -> DataFrame:
    """Seller and shipping limit of each order's lowest item number."""
    order = F.struct(_item_number().alias("number"), "seller_id", "shipping_limit_date")
    return (
        items.groupBy("order_id")
        .agg(F.min(order).alias("item"))
        .select("order_id", "item.seller_id", "item.shipping_limit_date")
    )


def sales_lines(
    orders: DataFrame,
    items: DataFrame,
    dim_customer: DataFrame,
    dim_seller: DataFrame,
    dim_product: DataFrame,
) -> DataFrame:
    """fact_sales with the line's product_id and seller_id, as it is stored and merged.

    Lines are shuffled twice, while they are narrow: to the versions of their products, which they
    take along as a list, and to their orders. There they are grouped, which needs no shuffle of its
    own, as rows of one order are together; a hot order is still split by the join. The
    result lies by order, so that what groups it by order combines before it shuffles.
    """
    purchased = "order_purchase_timestamp"
    delivered = "order_delivered_customer_date"
    due = "order_estimated_delivery_date"
    of_order = asof_join(
        orders.select("order_id", "customer_id", "order_status", purchased, delivered, due),
        dim_customer,
        {"customer_id": "customer_id"},
        purchased,
        ["customer_key"],
        plan="auto",
    )
    # Rows of one order_id are told apart, so that a repeated one repeats its lines, as a join does.
    attributes = ["_order", "customer_key", "order_status", purchased, delivered, due]
    of_order = of_order.withColumn("customer_key", packed_key("customer_key")).withColumn(
        "_order", F.monotonically_increasing_id()
    )
    items = items.select("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value")
    ids = ["order_id", "product_id", "seller_id"]
    items = pack(items.withColumns({k: packed_number(k) for k in ids}), _LINE_BITS, "_measures")
    keys = [*ids, *attributes]
    listed = listable(dim_product, "product_id")
    if listed:
        items = with_versions(items, dim_product, "product_id", "product_id", "product_key", "_versions")
    of_order = of_order.select(packed_number("order_id").alias("order_id"), *attributes)
    lines = unpack(items.join(of_order, "order_id"), _LINE_BITS, "_measures")
    if listed:
        lines = lines.withColumn("_products", valid_keys("_versions", purchased)).groupBy(*keys, "_products")
        lines = lines.agg(*_line_values()).withColumn("_product", F.explode_outer("_products"))
    else:
        lines = lines.groupBy(*keys).agg(*_line_values())
    lines = lines.withColumns({k: unpacked_number(k) for k in ids})
    if listed:
        lines = lines.withColumn("product_key", valid_surrogate("_product", "product_id"))
    else:
        lines = asof_join(
            lines, dim_product, {"product_id": "product_id"}, purchased, ["product_key"], plan="auto"
        )
    lines = asof_join(
        lines, dim_seller, {"seller_id": "seller_id"}, purchased, ["seller_key"], plan="auto"
    )
    lines = lines.select(
        "*",
        date_key(purchased).alias("purchase_time_key"),
        date_key(delivered).alias("delivery_time_key"),
        hash_key("order_status").alias("status_key"),
        F.when(F.col("order_status") == "canceled", 1).otherwise(0).alias("is_canceled"),
        F.datediff(delivered, due).alias("delivery_delay_days"),
        (F.col("sale_price") * F.col("quantity")).alias("total_value"),
    )
    lines = lines.withColumn("customer_key", unpacked_key("customer_key"))
    return lines.select(*SALES_COLUMNS, "product_id", "seller_id")


def fact_sales(
    orders: DataFrame,
    items: DataFrame,
    dim_customer: DataFrame,
    dim_seller: DataFrame,
    dim_product: DataFrame,
) -> DataFrame:
    return sales_lines(orders, items, dim_customer, dim_seller, dim_product).select(*SALES_COLUMNS)


def fact_payments(orders: DataFrame, payments: DataFrame) -> DataFrame:
    purchases = orders.select("order_id", date_key("order_purchase_timestamp").alias("time_key"))
    return (
        order_payments(payments)
        .join(purchases, "order_id", "left")
        .select(
            "order_id",
            hash_key("primary_payment_type").alias("payment_type_key"),
            "Num_payment_methods",
            "time_key",
            "Total_payment_value",
            "payment_installments",
        )
    )


def fact_reviews(
    reviews: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
) -> DataFrame:
    reviewed = "review_creation_date"
    rows = (
        reviews.select("review_id", "order_id", "review_score", reviewed)
        .join(orders.select("order_id", "customer_id"), "order_id", "left")
        .join(first_products(items), "order_id", "left")
    )
    rows = asof_join(
        rows, dim_customer, {"customer_id": "customer_id"}, reviewed, ["customer_key"], plan="auto"
    )
    rows = asof_join(
        rows, dim_product, {"product_id": "product_id"}, reviewed, ["product_key"], plan="auto"
    )
    return rows.select(
        F.col("review_id").alias("Review_id"),
        F.col("order_id").alias("Order_id"),
        "customer_key",
        "product_key",
        F.col("review_score").alias("Review_score"),
        date_key(reviewed).alias("time_key"),
    )


def fact_shipment(
    orders: DataFrame, items: DataFrame, dim_customer: DataFrame, dim_seller: DataFrame
) -> DataFrame:
    purchased = "order_purchase_timestamp"
    delivered = "order_delivered_customer_date"
    rows = orders.join(first_items(items), "order_id")
    rows = asof_join(
        rows, dim_customer, {"customer_id": "customer_id"}, purchased, ["customer_key"], plan="auto"
    )
    rows = asof_join(
        rows, dim_seller, {"seller_id": "seller_id"}, purchased, ["seller_key"], plan="auto"
    )
    delay = F.datediff(delivered, "order_estimated_delivery_date")
    return rows.select(
        hash_key("order_id").alias("shipment_key"),
        "order_id",
        "customer_key",
        "seller_key",
        date_key("shipping_limit_date").alias("shipping_limit_date"),
        date_key("order_delivered_carrier_date").alias("delivered_carrier_date"),
        date_key(delivered).alias("delivered_customer_date"),
        date_key("order_estimated_delivery_date").alias("estimated_delivery_date"),
        delay.alias("delivery_delay_days"),
        F.datediff(delivered, "order_delivered_carrier_date").alias("carrier_to_customer_days"),
        F.when(delay > 0, 1).otherwise(0).alias("is_late_delivery"),
    )


def merge_fact(name: str, held: DataFrame, fresh: DataFrame) -> DataFrame:
    """Merge a recomputed fact (sales: its lines) by its natural key.

    Rows are shuffled packed. Text of the natural key is never NULL there, so that the check for
    repeated keys needs no shuffle of its own. The surrogate of a first version, which its
    business key in the same row makes again, is left out.
    """
    natural = FACT_KEYS[name]
    text = {c for c, kind in held.dtypes if kind == "string"}
    ids = [c for c in natural if c in text]
    surrogates = [c for c in held.columns if c in text and c.endswith("_key") and c not in natural]
    bits = MERGE_BITS if held.dtypes == fresh.dtypes else ()

    def first(surrogate: str) -> Column | None:
        """The surrogate of the first version of the row's business key, if the row has that."""
        business = surrogate.removesuffix("_key") + "_id"
        return version_key(business, F.lit(FIRST_EFFECTIVE).cast("timestamp_ntz")) if business in ids else None

    def packed(rows: DataFrame) -> DataFrame:
        columns = {c: F.coalesce((packed_key if c.endswith("_key") else packed_number)(c), F.lit(b"")) for c in ids}
        for c in surrogates:
            if c in rows.columns:
                made, key = first(c), packed_key(c)
                columns[c] = key if made is None else F.when(F.col(c) == made, F.lit(b"")).otherwise(key)
        rows = rows.withColumns(columns)
        for i, widths in enumerate(bits):
            rows = pack(rows, _held_by(rows, widths), f"_packed{i}")
        return rows

    merged = merge_into(packed(held), packed(fresh), natural)
    for i, widths in enumerate(bits):
        merged = unpack(merged, _held_by(merged, widths), f"_packed{i}")
    merged = merged.withColumns(
        {c: F.when(F.col(c) != F.lit(b""), (unpacked_key if c.endswith("_key") else unpacked_number)(c)) for c in ids}
    )
    again = {}
    for c in surrogates:
        made = first(c)
        again[c] = unpacked_key(c) if made is None else F.when(F.col(c) == F.lit(b""), made).otherwise(unpacked_key(c))
    return merged.withColumns(again)


def _held_by(rows: DataFrame, widths: Mapping[str, int]) -> dict[str, int]:
    return {c: width for c, width in widths.items() if c in rows.columns}
