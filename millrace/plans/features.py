"""Order-level features for training and scoring, from the warehouse facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import exact_mean, key_date, ratio

# The model's inputs, the label rule and the freight flag.
FEATURES = (
    "delivery_delay",
    "delivery_time",
    "price_sum",
    "price_mean",
    "freight_sum",
    "freight_mean",
    "freight_ratio",
    "item_count",
    "is_high_freight",
    "price_per_item",
    "delay_ratio",
)
REQUIRED = ("review_score", "delivery_delay", "delivery_time", "price_sum", "freight_sum")
GOOD_SCORE = 4
HIGH_FREIGHT = 0.5


def order_sums(fact_sales: DataFrame) -> DataFrame:
    """Sums and means per order. Delay and date keys belong to the order, so any line has them."""
    return fact_sales.groupBy("order_id").agg(
        F.sum(F.col("sale_price") * F.col("quantity")).cast("double").alias("price_sum"),
        exact_mean("sale_price").alias("price_mean"),
        F.sum("freight_value").cast("double").alias("freight_sum"),
        exact_mean("freight_value").alias("freight_mean"),
        F.sum("quantity").alias("item_count"),
        F.min("delivery_delay_days").alias("delivery_delay"),
        F.min("purchase_time_key").alias("purchase_time_key"),
        F.min("delivery_time_key").alias("delivery_time_key"),
    )


def _with_ratios(sums: DataFrame, flag_type: str) -> DataFrame:
    timed = sums.select(
        "*",
        F.datediff(key_date("delivery_time_key"), key_date("purchase_time_key")).alias(
            "delivery_time"
        ),
        ratio(F.col("freight_sum"), F.col("price_sum")).alias("freight_ratio"),
    )
    return timed.select(
        "*",
        (F.col("freight_ratio") > HIGH_FREIGHT).cast(flag_type).alias("is_high_freight"),
        ratio(F.col("price_sum"), F.col("item_count")).alias("price_per_item"),
        ratio(F.col("delivery_delay"), F.col("delivery_time") + 1).alias("delay_ratio"),
    )


def scoring_features(fact_sales: DataFrame) -> DataFrame:
    """One row per order, without a label."""
    return _with_ratios(order_sums(fact_sales), "double")


def training_features(fact_sales: DataFrame, fact_reviews: DataFrame) -> DataFrame:
    """One row per review of an order with sales, with the label; incomplete rows dropped."""
    reviews = fact_reviews.select(
        F.col("Order_id").alias("order_id"), F.col("Review_score").alias("review_score")
    )
    rows = reviews.join(_with_ratios(order_sums(fact_sales), "int"), "order_id")
    return rows.na.drop(subset=list(REQUIRED)).select(
        "order_id",
        "review_score",
        (F.col("review_score") >= GOOD_SCORE).cast("int").alias("label"),
        "delivery_delay",
        "delivery_time",
        "price_sum",
        "price_mean",
        "freight_sum",
        "freight_mean",
        "freight_ratio",
        "is_high_freight",
        "price_per_item",
        "delay_ratio",
        "item_count",
    )
