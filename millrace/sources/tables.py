"""Mutable tables of Parquet files, and registration in the catalog.

Spark cannot overwrite a path it is reading, so each write of a snapshot table goes to a new
folder ``v=<n>`` and becomes the current one when its ``_SUCCESS`` file exists.
A job that dies half-way leaves the previous snapshot in force. Tables that are merged by small
batches lie in partitions instead, of which a batch replaces those it touches.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARTS = 16
_PART = "part_of_key"
_APPLIED = "_APPLIED"
_FOLDER = re.compile(r"^v=(\d+)(?:\.(.+))?$")


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, pattern: str) -> bool:
    """Whether a path, or any path of a glob pattern, exists."""
    fs, hadoop_path = _filesystem(spark, pattern)
    return bool(fs.globStatus(hadoop_path))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _filesystem(spark, path)
    fs.delete(hadoop_path, True)


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def snapshots(self) -> dict[int, str | None]:
        """Complete snapshots: version → tag of the write, oldest first."""
        fs, pattern = _filesystem(self.spark, f"{self.path}/v=*/_SUCCESS")
        found = {}
        for status in fs.globStatus(pattern) or []:
            match = _FOLDER.match(status.getPath().getParent().getName())
            if match:
                found[int(match.group(1))] = match.group(2)
        return dict(sorted(found.items()))

    def exists(self) -> bool:
        return bool(self.snapshots())

    def has_tag(self, tag: str) -> bool:
        return tag in self.snapshots().values()

    def folder(self) -> str:
        """Folder of the current snapshot."""
        versions = self.snapshots()
        if not versions:
            raise FileNotFoundError(f"no complete snapshot in {self.path}")
        version, tag = list(versions.items())[-1]
        return self._folder(version, tag)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.folder())

    def recover(self) -> None:
        """Nothing to finish: a write that was cut short is not in the table."""

    def read_for(self, rows: DataFrame) -> DataFrame:
        """The part of the table that a merge of ``rows`` must read and will write: all of it."""
        return self.read()

    def write(
        self, df: DataFrame, tag: str | None = None, partition_by: list[str] | None = None
    ) -> str:
        """Write the next snapshot. ``tag`` names the write, so a replay can be recognised."""
        version = max(self.snapshots(), default=0) + 1
        folder = self._folder(version, tag)
        # Surrogates are digests in hexadecimal, which only a codec with entropy coding makes smaller.
        writer = df.write.mode("overwrite").option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(folder)
        return folder

    def vacuum(self, keep: int = 2) -> None:
        """Drop all but the newest ``keep`` snapshots; tagged ones stay until a newer tag exists."""
        versions = self.snapshots()
        tagged = [v for v, tag in versions.items() if tag]
        retained = set(list(versions)[-keep:]) | set(tagged[-1:])
        for version, tag in versions.items():
            if version not in retained:
                fs, path = _filesystem(self.spark, self._folder(version, tag))
                fs.delete(path, True)

    def _folder(self, version: int, tag: str | None) -> str:
        return f"{self.path}/v={version:08d}" + (f".{tag}" if tag else "")


class PartitionedTable:
    """A table for merges that touch few of its keys: only their partitions are rewritten.

    Rows lie in partitions by a hash of the key, in plain Parquet folders that any reader knows.
    A write replaces the partitions it holds rows of and leaves the others alone. Its rows are
    stored as a batch first and moved by a dynamic partition overwrite, which may be cut
    short; the next writer then finishes it from the stored batch. The number of partitions is part of
    the folder names and cannot change.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], parts: int = PARTS):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.parts = parts
        self.rows = f"{self.path}/rows"

    def part(self) -> Column:
        number = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.parts))
        return F.concat(F.lpad(number.cast("string"), 6, "0"), F.lit(f"-{self.parts}"))

    def snapshots(self) -> dict[str, str]:
        """Writes that are in the table and whose batches are known: tag → folder."""
        return {name: folder for name, folder in self._batches().items() if self._exists(f"{folder}/{_APPLIED}")}

    def exists(self) -> bool:
        return bool(self._partitions())

    def has_tag(self, tag: str) -> bool:
        return tag in self.snapshots()

    def recover(self) -> None:
        """For the table's writer, before it reads: finish a write whose batch is stored completely."""
        for folder in self._batches().values():
            if not self._exists(f"{folder}/{_APPLIED}"):
                self._apply(folder)

    def read(self) -> DataFrame:
        return self._read().drop(_PART)

    def read_for(self, rows: DataFrame) -> DataFrame:
        """The partitions that hold keys of ``rows``; their names are bounded by the number of parts."""
        touched = [r[0] for r in rows.select(self.part()).distinct().collect()]
        return self._read().where(F.col(_PART).isin(touched)).drop(_PART)

    def write(self, df: DataFrame, tag: str | None = None) -> str:
        """Replace the partitions that ``df`` has rows of. ``tag`` names the write, so a replay can be
        recognised."""
        name = tag or uuid.uuid4().hex
        folder = f"{self.path}/batches/{name}"
        # Rebalanced, so that a partition becomes few files and a large one is still split.
        rows = df.withColumn(_PART, self.part()).hint("rebalance", _PART)
        rows.write.mode("overwrite").option("compression", "zstd").partitionBy(_PART).parquet(folder)
        self._apply(folder)
        for other, old in self._batches().items():
            if other != name:
                self._delete(old)
        return folder

    def vacuum(self, keep: int = 0) -> None:
        """Drop the rows of batches that are in the table; the last batch's mark stays."""
        for folder in self.snapshots().values():
            for part in self._names(f"{folder}/{_PART}=*"):
                self._delete(f"{folder}/{part}")

    def _apply(self, folder: str) -> None:
        if self._names(f"{folder}/{_PART}=*"):
            batch = self.spark.read.option("mergeSchema", "true").parquet(folder)
            writer = batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.option("compression", "zstd").partitionBy(_PART).parquet(self.rows)
        fs, mark = _filesystem(self.spark, f"{folder}/{_APPLIED}")
        fs.create(mark).close()

    def _read(self) -> DataFrame:
        found = self._partitions()
        if not found:
            raise FileNotFoundError(f"no rows in {self.path}")
        wrong = [p for p in found if not p.endswith(f"-{self.parts}")]
        if wrong:
            raise ValueError(f"{self.path} has another number of partitions: {wrong[0]}")
        return self.spark.read.option("mergeSchema", "true").parquet(self.rows)

    def _batches(self) -> dict[str, str]:
        """Completely stored batches."""
        base = f"{self.path}/batches"
        return {n: f"{base}/{n}" for n in self._names(f"{base}/*") if self._exists(f"{base}/{n}/_SUCCESS")}

    def _partitions(self) -> list[str]:
        return self._names(f"{self.rows}/{_PART}=*")

    def _names(self, pattern: str) -> list[str]:
        fs, path = _filesystem(self.spark, pattern)
        return sorted(status.getPath().getName() for status in fs.globStatus(path) or [])

    def _exists(self, path: str) -> bool:
        fs, hadoop_path = _filesystem(self.spark, path)
        return fs.exists(hadoop_path)

    def _delete(self, path: str) -> None:
        delete_path(self.spark, path)


def overwrite_and_register(
    spark: SparkSession, df: DataFrame, path: str, database: str, name: str
) -> DataFrame:
    """Write a full replacement and point ``database.name`` at it."""
    table = SnapshotTable(spark, path)
    table.write(df)
    register(spark, table, database, name)
    return spark.table(f"{database}.{name}")


def register(
    spark: SparkSession, table: SnapshotTable | PartitionedTable, database: str, name: str
) -> None:
    """Make the table's current rows queryable as ``database.name`` (an external table)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
    partitioned = isinstance(table, PartitionedTable)
    path = table.rows if partitioned else table.folder()
    spark.catalog.createTable(f"{database}.{name}", path=path, source="parquet")
    if partitioned:
        spark.catalog.recoverPartitions(f"{database}.{name}")
    spark.catalog.refreshTable(f"{database}.{name}")
