"""The nine source entities: columns, merge keys, load mode, change-record schemas."""

from __future__ import annotations

from dataclasses import dataclass

# Column names and types of the operational tables.
AUDIT = "created_date timestamp_ntz, last_modified_date timestamp_ntz"

DDL = {
    "customers": (
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
        f"customer_city string, customer_state string, {AUDIT}"
    ),
    "sellers": (
        "seller_id string, seller_zip_code_prefix string, seller_city string, "
        f"seller_state string, {AUDIT}"
    ),
    "products": (
        "product_id string, product_category_name string, product_name_lenght int, "
        "product_description_lenght int, product_photos_qty int, "
        "product_weight_g decimal(10,2), product_length_cm decimal(10,2), "
        f"product_height_cm decimal(10,2), product_width_cm decimal(10,2), {AUDIT}"
    ),
    "product_category_name_translation": (
        f"product_category_name string, product_category_name_english string, {AUDIT}"
    ),
    "geolocation": (
        "geolocation_zip_code_prefix string, geolocation_lat decimal(10,8), "
        f"geolocation_lng decimal(11,8), geolocation_city string, geolocation_state string, {AUDIT}"
    ),
    "orders": (
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
        "order_delivered_carrier_date timestamp_ntz, "
        "order_delivered_customer_date timestamp_ntz, "
        f"order_estimated_delivery_date timestamp_ntz, {AUDIT}"
    ),
    "order_items": (
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "shipping_limit_date timestamp_ntz, price decimal(10,2), "
        f"freight_value decimal(10,2), {AUDIT}"
    ),
    "order_payments": (
        "id int, order_id string, payment_sequential int, payment_type string, "
        f"payment_installments int, payment_value decimal(10,2), {AUDIT}"
    ),
    "order_reviews": (
        "review_id string, order_id string, review_score int, review_comment_title string, "
        "review_comment_message string, review_creation_date timestamp_ntz, "
        f"review_answer_timestamp timestamp_ntz, {AUDIT}"
    ),
}

# Every field of a change record arrives as text.
CHANGE_RECORD_DDL = {
    "orders": (
        "order_id STRING, customer_id STRING, order_status STRING, "
        "order_purchase_timestamp STRING, order_approved_at STRING, "
        "order_delivered_carrier_date STRING, order_delivered_customer_date STRING, "
        "order_estimated_delivery_date STRING"
    ),
    "order_items": (
        "order_id STRING, order_item_id STRING, product_id STRING, seller_id STRING, "
        "shipping_limit_date STRING, price STRING, freight_value STRING"
    ),
}


@dataclass(frozen=True)
class Entity:
    name: str
    keys: tuple[str, ...]
    mode: str  # "full", "incremental" or "cdc"
    watermark: str = "last_modified_date"

    @property
    def ddl(self) -> str:
        return DDL[self.name]

    @property
    def record_ddl(self) -> str | None:
        return CHANGE_RECORD_DDL.get(self.name)


ENTITIES = {
    e.name: e
    for e in (
        Entity("customers", ("customer_id",), "full"),
        Entity("sellers", ("seller_id",), "full"),
        Entity("products", ("product_id",), "full"),
        Entity("product_category_name_translation", ("product_category_name",), "full"),
        Entity("geolocation", ("geolocation_zip_code_prefix",), "full"),
        Entity("order_payments", ("id",), "incremental"),
        # The warehouse keys a review by both columns; one key in both layers
        # keeps a review id that is shared by two orders.
        Entity("order_reviews", ("review_id", "order_id"), "incremental"),
        Entity("orders", ("order_id",), "cdc"),
        Entity("order_items", ("order_id", "order_item_id"), "cdc"),
    )
}

# File names of the seed dataset, by entity.
SEED_FILES = {
    name: f"{name}.csv" if name == "product_category_name_translation" else f"*_{name}_dataset.csv"
    for name in DDL
}
