"""The loads of the lakehouse as jobs over one root folder.

    bronze/<entity>       landed snapshots, incremental extracts, change feeds
    silver/<entity>       cleaned entities
    dw_db/, mart_db/      dimensions and facts; marts
    features, model, alerts, watermarks, checkpoints/
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace.ml import evaluation, model, scoring
from millrace.plans.features import training_features
from millrace.plans.warehouse import FACTS, SILVER, Warehouse
from millrace.sources import landing, readers
from millrace.sources.entities import ENTITIES, SEED_FILES
from millrace.sources.tables import SnapshotTable, path_exists
from millrace.streaming import feed, silver

# Columns that the source database fills in by itself.
NOT_IN_SEED = ("id", "created_date", "last_modified_date")
# Columns that a landed change carries to order changes of equal time.
FEED_SEQUENCE = "offset"
# Landed bytes that one micro-batch of a refresh takes at most.
BATCH_BYTES = 4 << 30


class Lakehouse:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        active_only: bool = False,
        buckets: int | None = None,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.warehouse = Warehouse(spark, self.root, active_only, buckets)

    def path(self, *parts: str) -> str:
        return "/".join((self.root, *parts))

    # --- landing ---

    def seed(self, folder: str) -> dict[str, bool]:
        """Load the CSV files of a seed dataset into ``source/<entity>``, once each."""
        loaded = {}
        for name, file in SEED_FILES.items():
            if not path_exists(self.spark, f"{folder}/{file}"):
                continue
            schema = StructType(
                [f for f in StructType.fromDDL(ENTITIES[name].ddl) if f.name not in NOT_IN_SEED]
            )
            rows = landing.without_noise(readers.read_csv(self.spark, f"{folder}/{file}", schema))
            table = SnapshotTable(self.spark, self.path("source", name))
            loaded[name] = landing.load_once(rows, table)
        return loaded

    def extract(self, name: str, rows: DataFrame, logical_date: datetime) -> dict:
        """Land an entity: a snapshot, or what is newer than its stored watermark."""
        entity, path = ENTITIES[name], self.path("bronze", name)
        if entity.mode == "full":
            return landing.extract_full(rows, path, name)
        store = landing.WatermarkStore(self.spark, self.path("watermarks"))
        done = landing.extract_incremental(
            rows, path, name, entity.watermark, store.get(name), logical_date
        )
        store.advance(done)
        return done

    def land_changes(
        self, feeds: dict[str, DataFrame], processing_time: Column | None = None, **options
    ) -> dict[str, StreamingQuery]:
        """Start landing the change feeds of several entities."""
        return feed.land_topics(
            feeds, self.root, carry=[FEED_SEQUENCE], processing_time=processing_time, **options
        )

    # --- cleaned entities ---

    def refresh_entity(
        self, name: str, source_keys: DataFrame | None = None, record_ddl: str | None = None
    ) -> None:
        """Bring the cleaned entity up to date with what is landed.

        source_keys: keys now present at the source of an incremental entity,
        for the sweep of rows deleted there.
        """
        entity, bronze = ENTITIES[name], self.path("bronze", name)
        if entity.mode == "full":
            self.warehouse.load_snapshot(name, readers.read_parquet(self.spark, bronze))
            return
        # Bounds a batch, and so what is cached of it, however long the backlog is.
        stream = feed.file_feed(self.spark, bronze, max_bytes=BATCH_BYTES)
        table = self.warehouse.table(SILVER, name).path
        checkpoint = self.path("checkpoints", "silver", name)
        if entity.mode == "cdc":
            query = silver.merge_change_stream(
                stream,
                table,
                checkpoint,
                entity.keys,
                record_ddl or entity.record_ddl,
                name,
                FEED_SEQUENCE,
                rejects=self.path("rejects", "silver", name),
                buckets=self.warehouse.buckets,
            )
        else:
            query = silver.merge_row_stream(
                stream.drop("year", "month", "day"),
                table,
                checkpoint,
                entity.keys,
                entity.watermark,
                name,
                buckets=self.warehouse.buckets,
            )
        feed.finish(query)
        if source_keys is not None and entity.mode == "incremental":
            self.warehouse.sweep(name, source_keys)

    # --- warehouse and marts ---

    def refresh_dimensions(self, now: str) -> None:
        self.warehouse.load_dimensions(now)

    def refresh_facts(self) -> None:
        for name in FACTS:
            self.warehouse.load_fact(name)

    def refresh_mart(self, name: str) -> None:
        self.warehouse.load_mart(name)

    # --- model ---

    def refresh_features(self) -> None:
        rows = training_features(
            self.warehouse.read("fact_sales"), self.warehouse.read("fact_reviews")
        )
        table = SnapshotTable(self.spark, self.path("features"))
        table.write(rows)
        table.vacuum()

    def features(self) -> DataFrame:
        return SnapshotTable(self.spark, self.path("features")).read()

    def train(self, optimize: str = "recall0", **options) -> tuple[DataFrame, float, float]:
        """Train and save; returns the report, the chosen threshold and the area under the curve."""
        _, scored = model.train(self.features(), self.path("model"), **options)
        threshold, _ = evaluation.best_threshold(scored, mode=optimize)
        report = evaluation.classification_report(scored, threshold)
        return report, threshold, model.roc_auc(scored)

    def score(self, scored_at: str, threshold: float = scoring.ALERT_THRESHOLD) -> None:
        """Append alerts for orders that are new since the last ones."""
        path = self.path("alerts")
        held = None
        if path_exists(self.spark, path):
            held = self.spark.read.schema(scoring.ALERT_DDL).parquet(path)
        alerts = scoring.score_new_orders(
            self.warehouse.read("fact_sales"),
            self.features(),
            model.load_model(self.path("model")),
            held,
            scored_at,
            threshold,
        )
        alerts.write.mode("append").parquet(path)


def jdbc_source(spark: SparkSession, url: str, **options: object) -> Callable[[str], DataFrame]:
    """Entities of a relational source, by name. The database's driver must be on the class path."""
    return lambda name: readers.read_jdbc(spark, url, name, **options)
