"""Per-entity cleaning rules, applied as one projection."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from millrace.functions.columns import epoch_ms_to_ts

MONEY = "decimal(12,2)"

# Fill-ins and limits of the rules.
UNKNOWN_CITY = "unknown"
UNKNOWN_STATE = "UN"
ZIP_DIGITS = 5
REVIEW_YEARS = (2000, 2050)

ORDER_TIMES = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)

Getter = Callable[[str], Column]


def zip_code(column: Column) -> Column:
    """Five digits, left-padded; longer text is cut to five."""
    return F.lpad(column.cast("string"), ZIP_DIGITS, "0")


def plausible_date(column: Column) -> Column:
    ts = column.try_cast("timestamp_ntz")
    return F.when(F.year(ts).between(*REVIEW_YEARS), ts)


def _place(prefix: str, c: Getter) -> dict[str, Column]:
    return {
        f"{prefix}_zip_code_prefix": zip_code(c(f"{prefix}_zip_code_prefix")),
        f"{prefix}_city": F.coalesce(F.lower(c(f"{prefix}_city")), F.lit(UNKNOWN_CITY)),
        f"{prefix}_state": F.coalesce(F.upper(c(f"{prefix}_state")), F.lit(UNKNOWN_STATE)),
    }


def _customers(c: Getter) -> dict[str, Column]:
    return _place("customer", c)


def _sellers(c: Getter) -> dict[str, Column]:
    return _place("seller", c)


def _orders(c: Getter) -> dict[str, Column]:
    return {"order_status": F.lower(c("order_status"))}


def _order_items(c: Getter) -> dict[str, Column]:
    return {
        name: F.coalesce(c(name).try_cast(MONEY), F.lit(0).cast(MONEY))
        for name in ("price", "freight_value")
    }


def _order_payments(c: Getter) -> dict[str, Column]:
    return {
        "payment_value": F.coalesce(c("payment_value").try_cast(MONEY), F.lit(0).cast(MONEY)),
        "payment_installments": F.coalesce(c("payment_installments").try_cast("int"), F.lit(1)),
        "payment_type": F.lower(c("payment_type")),
    }


def _order_reviews(c: Getter) -> dict[str, Column]:
    return {
        "review_score": c("review_score").try_cast("int"),
        "review_creation_date": plausible_date(c("review_creation_date")),
        "review_answer_timestamp": plausible_date(c("review_answer_timestamp")),
    }


def _products(c: Getter) -> dict[str, Column]:
    measures = (
        "product_name_lenght",
        "product_description_lenght",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )
    rules = {name: c(name).try_cast("double") for name in measures}
    rules["product_photos_qty"] = c("product_photos_qty").try_cast("int")
    return rules


def _geolocation(c: Getter) -> dict[str, Column]:
    return {
        "geolocation_zip_code_prefix": zip_code(c("geolocation_zip_code_prefix")),
        "geolocation_lat": c("geolocation_lat").try_cast("double"),
        "geolocation_lng": c("geolocation_lng").try_cast("double"),
        "geolocation_city": F.lower(c("geolocation_city")),
        "geolocation_state": F.upper(c("geolocation_state")),
    }


RULES: dict[str, Callable[[Getter], dict[str, Column]]] = {
    "customers": _customers,
    "sellers": _sellers,
    "orders": _orders,
    "order_items": _order_items,
    "order_payments": _order_payments,
    "order_reviews": _order_reviews,
    "products": _products,
    "geolocation": _geolocation,
}

# Columns that a change record carries as epoch milliseconds.
EPOCH_MS = {"orders": ORDER_TIMES, "order_items": ("shipping_limit_date",)}


def trimmed(df: DataFrame) -> dict[str, Column]:
    """Every column; text columns trimmed."""
    return {
        f.name: F.trim(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
        for f in df.schema.fields
    }


def trim_all(df: DataFrame) -> DataFrame:
    return df.select(*[column.alias(name) for name, column in trimmed(df).items()])


def clean(df: DataFrame, entity: str) -> DataFrame:
    """Trim all text, then apply the rules of ``entity``; other columns pass through.

    An entity without rules (the category translation) is trimmed only. A time
    column of a change record is decoded when present as text or number, and
    left alone when it is a timestamp already.
    """
    columns = trimmed(df)
    if entity in RULES:
        columns |= RULES[entity](columns.__getitem__)
    for name in EPOCH_MS.get(entity, ()):
        if name in columns and isinstance(df.schema[name].dataType, StringType | NumericType):
            columns[name] = epoch_ms_to_ts(columns[name])
    return df.select(*[column.alias(name) for name, column in columns.items()])
