"""The stored layers: cleaned entities, dimensions, facts and marts, each a snapshot table.

Each load reads stored tables and writes one, as a job of its own. So a plan
never spans more than one load, a lost executor repeats at most that load, and
Spark plans each one with the real sizes of its inputs.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.cleaning import zip_code
from millrace.operators.merge import sweep_deleted
from millrace.operators.scd import scd2_apply, scd2_initial
from millrace.plans import dimensions as dims
from millrace.plans import facts
from millrace.plans.marts import MARTS, build_mart
from millrace.sources.entities import ENTITIES
from millrace.sources.catalog import buckets_for, save_bucketed
from millrace.sources.tables import PartitionedTable, SnapshotTable, register
from millrace.streaming.silver import apply_rows, open_table, snapshot_rows

VERSIONED = {
    "dim_customer": (dims.CUSTOMER, "customers", dims.customer_rows),
    "dim_seller": (dims.SELLER, "sellers", dims.seller_rows),
    "dim_product": (dims.PRODUCT, "products", dims.product_rows),
}
REPLACED = {
    "dim_geolocation": ("geolocation", dims.dim_geolocation),
    "dim_product_category": ("product_category_name_translation", dims.dim_product_category),
    "dim_status": ("orders", dims.dim_status),
    "dim_payment_type": ("order_payments", dims.dim_payment_type),
}
# Dates that facts refer to.
CALENDAR_DATES = {
    "orders": (
        "order_purchase_timestamp",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ),
    "order_items": ("shipping_limit_date",),
    "order_reviews": ("review_creation_date",),
}
BY_ORDER = ("orders", "order_items", "order_payments", "order_reviews")
FACTS = ("fact_sales", "fact_reviews", "fact_payments", "fact_shipment")

SILVER, GOLD, MART = "silver", "dw_db", "mart_db"


class Warehouse:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        active_only: bool = False,
        buckets: int | None = None,
    ):
        """active_only: leave soft-deleted rows of the cleaned entities out of the loads.
        buckets: partitions of the cleaned entities, for merges that touch few. Entities that are
        merged as whole extracts are snapshots unless it is given.
        """
        self.spark = spark
        self.root = root.rstrip("/")
        self.active_only = active_only
        self.buckets = buckets

    def table(self, layer: str, name: str) -> SnapshotTable | PartitionedTable:
        if layer == SILVER and (self.buckets or ENTITIES[name].mode != "full"):
            return open_table(
                self.spark, f"{self.root}/{layer}/{name}", ENTITIES[name].keys, self.buckets
            )
        return SnapshotTable(self.spark, f"{self.root}/{layer}/{name}")

    def read(self, name: str) -> DataFrame:
        """A stored dimension or fact."""
        rows = self.table(GOLD, name).read()
        return rows.select(*facts.SALES_COLUMNS) if name == "fact_sales" else rows

    def entity(self, name: str) -> DataFrame:
        """A stored cleaned entity."""
        rows = self.table(SILVER, name).read()
        return rows.where("is_active") if self.active_only and "is_active" in rows.columns else rows

    # --- cleaned entities ---

    def load_snapshot(self, name: str, rows: DataFrame) -> dict[str, int]:
        """Merge a full extract; rows it lacks become inactive."""
        entity = ENTITIES[name]
        latest = snapshot_rows(rows, entity.keys, entity.watermark, name)
        return apply_rows(
            self.table(SILVER, name), latest, entity.keys, absent={"is_active": False}, unique=True
        )

    def sweep(self, name: str, source_keys: DataFrame) -> int:
        """Mark rows deleted at the source as inactive; writes nothing when there are none.

        The source's keys are brought into the form that cleaning gives them.
        """
        entity = ENTITIES[name]
        table = self.table(SILVER, name)
        held = table.read()
        keys = source_keys.select(*[_as_cleaned(k).cast(held.schema[k].dataType).alias(k) for k in entity.keys])
        swept = sweep_deleted(held, keys, entity.keys)
        gone = swept.where("_action = 'soft_delete'").count()
        if gone:
            table.write(swept.drop("_action"))
            table.vacuum()
        return gone

    # --- dimensions ---

    def load_versioned(self, name: str, rows: DataFrame, now: str) -> None:
        """First load, or one more set of versions opened at ``now``."""
        spec, _, _ = VERSIONED[name]
        table = self.table(GOLD, name)
        if not table.exists():
            loaded = scd2_initial(rows, spec.business_key, spec.surrogate)
        else:
            loaded = scd2_apply(
                table.read(), rows, spec.business_key, spec.surrogate, spec.tracked, now
            )
        # Split so that a load reads only current versions into its join.
        table.write(loaded, partition_by=["is_current"])
        table.vacuum()

    def replace(self, name: str, rows: DataFrame) -> None:
        table = self.table(GOLD, name)
        table.write(rows)
        table.vacuum()

    def _calendar(self) -> DataFrame:
        dates = None
        for name, columns in CALENDAR_DATES.items():
            rows = self.entity(name).select(F.explode(F.array(*columns)).alias("day"))
            dates = rows if dates is None else dates.union(rows)
        return dims.dim_time_covering(dates, "day")

    def load_dimensions(self, now: str, calendar: DataFrame | None = None) -> None:
        """All dimensions from the stored entities. The calendar holds every date of the orders."""
        self.replace("dim_time", self._calendar() if calendar is None else calendar)
        for name, (source, build) in REPLACED.items():
            self.replace(name, build(self.entity(source)))
        for name, (_, source, rows_of) in VERSIONED.items():
            self.load_versioned(name, rows_of(self.entity(source)), now)

    # --- facts ---

    def fact(self, name: str, entities: Mapping[str, DataFrame] | None = None) -> DataFrame:
        """A fact computed from cleaned entities (the stored ones unless given)."""
        e = _Entities(self, entities or {})
        customer, seller, product = (self.read(n) for n in VERSIONED)
        if name == "fact_sales":
            return facts.fact_sales(e["orders"], e["order_items"], customer, seller, product)
        if name == "sales_lines":
            return facts.sales_lines(e["orders"], e["order_items"], customer, seller, product)
        if name == "fact_payments":
            return facts.fact_payments(e["orders"], e["order_payments"])
        if name == "fact_reviews":
            return facts.fact_reviews(
                e["order_reviews"], e["orders"], e["order_items"], customer, product
            )
        if name == "fact_shipment":
            return facts.fact_shipment(e["orders"], e["order_items"], customer, seller)
        raise ValueError(f"Unsupported fact table: {name}")

    def load_fact(
        self, name: str, entities: Mapping[str, DataFrame] | None = None
    ) -> dict[str, int]:
        """Create the fact, or merge its rows by natural key."""
        rows = self.fact("sales_lines" if name == "fact_sales" else name, entities)
        return apply_rows(self.table(GOLD, name), rows, facts.FACT_KEYS[name])

    # --- marts ---

    def mart(self, name: str) -> DataFrame:
        return build_mart(name, _Stored(self))

    def load_mart(self, name: str) -> None:
        table = self.table(MART, name)
        table.write(self.mart(name))
        table.vacuum()

    def publish_bucketed(self, database: str = "silver_by_order") -> dict[str, DataFrame]:
        """Copies of the entities of orders as catalog tables bucketed by order, to be given to ``fact``
        as ``entities``: groupings and joins of their lines by order then need no shuffle."""
        rows = {name: self.entity(name) for name in BY_ORDER}
        buckets = buckets_for(*rows.values())
        return {n: save_bucketed(df, database, n, ["order_id"], buckets) for n, df in rows.items()}

    def publish(self) -> None:
        """Register every stored table in the session's catalog."""
        for layer, names in (
            (SILVER, ENTITIES),
            (GOLD, (*VERSIONED, *REPLACED, "dim_time", *FACTS)),
            (MART, MARTS),
        ):
            for name in names:
                table = self.table(layer, name)
                if table.exists():
                    prefix = "clean_" if layer == SILVER else ""
                    register(self.spark, table, layer, f"{prefix}{name}")


def _as_cleaned(key: str) -> Column:
    return zip_code(F.col(key)) if key.endswith("zip_code_prefix") else F.trim(F.col(key).cast("string"))


class _Entities:
    def __init__(self, warehouse: Warehouse, given: Mapping[str, DataFrame]):
        self.warehouse = warehouse
        self.given = given

    def __getitem__(self, name: str) -> DataFrame:
        return self.given[name] if name in self.given else self.warehouse.entity(name)


class _Stored:
    def __init__(self, warehouse: Warehouse):
        self.warehouse = warehouse

    def __getitem__(self, name: str) -> DataFrame:
        return self.warehouse.read(name)
