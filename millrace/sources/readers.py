"""Batch readers. Each returns a lazy DataFrame with a declared schema where one is known."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """CSV with a header line. The declared schema avoids an inference pass over the data."""
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=False)


def read_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    num_partitions: int = 64,
    fetch_size: int = 10_000,
    **options: str,
) -> DataFrame:
    """Relational table or ``(subquery) AS alias``, read in parallel slices.

    Filters and column selections made on the result are pushed into the
    database by Spark. Without a partition column the read is one task, which
    is right for small tables only. With one, and without bounds, the database is
    asked for its least and greatest value first; an empty table is read as one slice.
    """
    if partition_column and bounds is None:
        bounds = jdbc_bounds(spark, url, table, partition_column, **options)
        if bounds is None:
            partition_column = None
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("fetchsize", str(fetch_size))
        .options(**options)
    )
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", str(num_partitions))
        )
    return reader.load()


def jdbc_bounds(
    spark: SparkSession, url: str, table: str, column: str, **options: str
) -> tuple[object, object] | None:
    """Least and greatest value of a column, computed by the database; None without values."""
    query = f"(SELECT MIN({column}) AS low, MAX({column}) AS high FROM {table}) AS bounds"
    low, high = read_jdbc(spark, url, query, **options).first()
    return None if low is None else (low, high)


def read_jdbc_keys(
    spark: SparkSession, url: str, table: str, keys: list[str], **kwargs
) -> DataFrame:
    """Only the key columns of a relational table, for the hard-delete sweep."""
    names = list(dict.fromkeys([*keys, kwargs.get("partition_column") or keys[0]]))
    rows = read_jdbc(spark, url, f"(SELECT {', '.join(names)} FROM {table}) AS tmp", **kwargs)
    return rows.select(*keys)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, plus a TOTAL row."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in sorted(tables.items())
    ]
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    return (
        counts.rollup("table_name")
        .agg(F.sum("row_count").alias("row_count"))
        .select(F.coalesce("table_name", F.lit("TOTAL")).alias("table_name"), "row_count")
    )
