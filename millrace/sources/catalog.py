"""Catalog tables bucketed by a key, so that joins and groupings by it need no shuffle."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from millrace.session import plan_bytes

# Of the estimated size. A bucket is grouped or sorted by one task, which adaptive execution can't divide.
BUCKET_BYTES = 64 << 20
LEAST_BUCKETS = 8


def buckets_for(*tables: DataFrame) -> int:
    """A number of buckets for tables that are joined with each other: a power of two, so that
    tables of different numbers still fit together, from the size of the largest."""
    wanted = max(plan_bytes(t) for t in tables) / BUCKET_BYTES
    return max(LEAST_BUCKETS, 1 << math.ceil(math.log2(max(1.0, wanted))))


def save_bucketed(
    df: DataFrame,
    database: str,
    name: str,
    keys: Sequence[str],
    buckets: int,
    path: str | None = None,
) -> DataFrame:
    """Replace ``database.name`` by ``df`` in ``buckets`` buckets of ``keys``, sorted by them.

    Rows are dealt by key before they are written, so that a bucket is one file. Without a path the
    table lies in the catalog's warehouse. Returns the table.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    writer = (
        df.repartition(buckets, *keys)
        .write.mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
    )
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(f"{database}.{name}")
    return spark.table(f"{database}.{name}")


def drop_database(spark: SparkSession, database: str) -> None:
    """Drop a database and its tables; files of tables with a path of their own stay."""
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
