"""Dimensions of the star schema, from cleaned entities."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import date_key, hash_key
from millrace.operators.dedup import distinct_values, first_per_key

# The calendar's default range and its weekend days.
CALENDAR = ("2008-01-01", "2030-12-31")
WEEKEND = ("Sat", "Sun")


@dataclass(frozen=True)
class Versioned:
    """What the type-2 operators need to know about a dimension."""

    business_key: str
    surrogate: str
    tracked: tuple[str, ...]


CUSTOMER = Versioned("customer_id", "customer_key", ("city_key",))
SELLER = Versioned("seller_id", "seller_key", ("city_key",))
PRODUCT = Versioned(
    "product_id", "product_key", ("category_key", "weight", "length", "height", "width")
)


def customer_rows(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", "customer_unique_id", hash_key("customer_zip_code_prefix").alias("city_key")
    )


def seller_rows(sellers: DataFrame) -> DataFrame:
    return sellers.select("seller_id", hash_key("seller_zip_code_prefix").alias("city_key"))


def product_rows(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id",
        hash_key("product_category_name").alias("category_key"),
        F.col("product_weight_g").alias("weight"),
        F.col("product_length_cm").alias("length"),
        F.col("product_height_cm").alias("height"),
        F.col("product_width_cm").alias("width"),
    )


def dim_geolocation(geolocation: DataFrame) -> DataFrame:
    """One row per zip code; its four values come from the same source row."""
    zip_code = "geolocation_zip_code_prefix"
    values = ["geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state"]
    order = [F.col(c).asc_nulls_last() for c in values]
    return first_per_key(geolocation, [zip_code], order).select(
        hash_key(zip_code).alias("geolocation_key"),
        F.col(zip_code).alias("zip_code_prefix"),
        *[F.col(c).alias(c.removeprefix("geolocation_")) for c in values],
    )


def dim_product_category(translation: DataFrame) -> DataFrame:
    return translation.select(
        hash_key("product_category_name").alias("category_key"),
        F.col("product_category_name").alias("category_name_pt"),
        F.col("product_category_name_english").alias("category_name_en"),
    )


def dim_status(orders: DataFrame) -> DataFrame:
    return distinct_values(orders, "order_status").select(
        hash_key("order_status").alias("status_key"), "order_status"
    )


def dim_payment_type(payments: DataFrame) -> DataFrame:
    return distinct_values(payments, "payment_type").select(
        hash_key("payment_type").alias("payment_type_key"), "payment_type"
    )


def dim_time(spark: SparkSession, start: str = CALENDAR[0], end: str = CALENDAR[1]) -> DataFrame:
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end")
    )
    return _calendar(bounds)


def dim_time_covering(dates: DataFrame, column: str) -> DataFrame:
    """The default calendar, widened where needed to hold every date of ``column``."""
    day = F.col(column).cast("date")
    start, end = (F.lit(d).cast("date") for d in CALENDAR)
    bounds = dates.agg(
        F.least(F.min(day), start).alias("start"), F.greatest(F.max(day), end).alias("end")
    )
    return _calendar(bounds)


def _calendar(bounds: DataFrame) -> DataFrame:
    step = F.make_dt_interval(days=F.lit(1))
    days = bounds.select(F.explode(F.sequence("start", "end", step)).alias("full_date"))
    weekday = F.date_format("full_date", "E")
    return days.select(
        date_key("full_date").alias("time_key"),
        "full_date",
        F.dayofmonth("full_date").alias("day"),
        F.month("full_date").alias("month"),
        F.quarter("full_date").alias("quarter"),
        F.year("full_date").alias("year"),
        weekday.alias("day_of_week"),
        F.when(weekday.isin(*WEEKEND), 1).otherwise(0).alias("is_weekend"),
    )
