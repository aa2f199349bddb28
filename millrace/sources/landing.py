"""Landing of source tables: CSV seed, full and incremental extracts, watermarks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.operators.merge import upsert
from millrace.sources.tables import SnapshotTable

# Fixed value: the watermark of a first run.
FIRST_WATERMARK = "1900-01-01 00:00:00"


def without_noise(df: DataFrame) -> DataFrame:
    """Drop rows that are NULL in every column, and full-row duplicates."""
    return df.na.drop("all").dropDuplicates()


def load_once(df: DataFrame, table: SnapshotTable) -> bool:
    """Write ``df`` unless the table already has rows. Returns whether it was written."""
    if table.exists() and not table.read().isEmpty():
        return False
    table.write(df)
    return True


def extract_full(df: DataFrame, path: str, table: str) -> dict:
    """Overwrite one snapshot; the row count is observed during the write, not by a second scan."""
    seen = Observation(f"full_{table}")
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return {
        "table": table,
        "mode": "full",
        "row_count": seen.get["n"],
        "column_count": len(df.columns),
        "columns": df.columns,
        "path": path,
    }


def newer_than(df: DataFrame, watermark_col: str, last_watermark: str | None) -> DataFrame:
    """Rows strictly above the last watermark; the comparison is pushed into the scan."""
    last = F.lit(last_watermark or FIRST_WATERMARK).cast(df.schema[watermark_col].dataType)
    return df.where(F.col(watermark_col) > last)


def with_landing_date(df: DataFrame, logical_date: datetime) -> DataFrame:
    """Constant ``year``, ``month`` and ``day`` text columns for the landing folders."""
    return df.select(
        "*",
        F.lit(f"{logical_date:%Y}").alias("year"),
        F.lit(f"{logical_date:%m}").alias("month"),
        F.lit(f"{logical_date:%d}").alias("day"),
    )


def extract_incremental(
    df: DataFrame,
    path: str,
    table: str,
    watermark_col: str,
    last_watermark: str | None,
    logical_date: datetime,
) -> dict:
    """Append the rows above the watermark to ``year=/month=/day=`` folders.

    One pass: the count and the new watermark are observed while writing.
    """
    seen = Observation(f"incremental_{table}")
    fresh = newer_than(df, watermark_col, last_watermark).observe(
        seen,
        F.count(F.lit(1)).alias("n"),
        F.max(watermark_col).cast("string").alias("newest"),
    )
    (
        with_landing_date(fresh, logical_date)
        .write.mode("append")
        .partitionBy("year", "month", "day")
        .parquet(path)
    )
    found = seen.get
    if not found["n"]:
        return {"table": table, "mode": "incremental", "row_count": 0, "status": "skipped"}
    return {
        "table": table,
        "mode": "incremental",
        "row_count": found["n"],
        "path": path,
        "watermark_used": last_watermark or FIRST_WATERMARK,
        "new_watermark": found["newest"],
        "logical_date": str(logical_date),
    }


class WatermarkStore:
    """One row per table: the newest watermark that was extracted."""

    SCHEMA = "table_name string, watermark string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = SnapshotTable(spark, path)

    def read(self) -> DataFrame:
        if not self.table.exists():
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.table.read()

    def get(self, table_name: str) -> str | None:
        row = self.read().where(F.col("table_name") == table_name).first()
        return row["watermark"] if row else None

    def advance(self, extracted: dict) -> None:
        """Take the watermark of an extract's metadata; a skipped extract changes nothing."""
        if extracted.get("status") == "skipped" or "new_watermark" not in extracted:
            return
        row = [(extracted["table"], extracted["new_watermark"])]
        self.table.write(upsert(self.read(), self.spark.createDataFrame(row, self.SCHEMA), ["table_name"]))
        self.table.vacuum()
