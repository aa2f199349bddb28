"""Archived topics as a stream with offsets of its own: a Python streaming data source.

An archive keeps messages as Parquet below ``topic=<name>/partition=<number>/`` with their offsets.
It is read with the options and columns of a live topic, so that a query over one runs over the other:
where to start, what to do about messages that are gone, and one task per topic partition
(or several, where there is much to read). What was read is told by offsets, not by file names: files may be
rewritten or merged as long as offsets stay.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp_ntz"
STARTS = ("earliest", "latest")
OFFSETS_PER_TASK = 1_000_000

_PLACE = re.compile(r"topic=([^/]+)/partition=(\d+)/[^/]+\.parquet$")


def archive_topic(messages: DataFrame, path: str, topic: str, partition: str = "partition", order: str = "offset") -> None:
    """Append messages (value, and key and timestamp where there are) with their partition and offset."""
    columns = set(messages.columns)
    rows = messages.select(
        (F.col("key") if "key" in columns else F.lit(None)).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.col(order).cast("long").alias("offset"),
        (F.col("timestamp") if "timestamp" in columns else F.lit(None)).cast("timestamp_ntz").alias("timestamp"),
        F.lit(topic).alias("topic"),
        F.col(partition).cast("int").alias("partition"),
    )
    # A file holds a range of offsets, which its footer tells.
    rows.repartition("partition").sortWithinPartitions("partition", "offset").write.mode("append").partitionBy(
        "topic", "partition"
    ).parquet(path)


@dataclass
class Slice(InputPartition):
    topic: str
    partition: int
    start: int
    end: int
    files: list[str] = field(default_factory=list)


@dataclass
class _File:
    path: str
    first: int
    last: int


class ArchiveReader(DataSourceStreamReader):
    """Offsets are {"topic/partition": next offset}."""

    def __init__(self, options: dict[str, str]):
        options = {name.lower(): value for name, value in options.items()}
        self.fs, self.root = fs.FileSystem.from_uri(_uri(options["path"]))
        self.topics = [t.strip() for t in options["subscribe"].split(",")]
        self.start = options.get("startingoffsets", "earliest")
        self.strict = options.get("failondataloss", "true").lower() == "true"
        self.per_task = int(options.get("offsetspertask", OFFSETS_PER_TASK))
        self._files: dict[str, tuple[str, _File] | None] = {}
        if self.start not in STARTS:
            json.loads(self.start)  # {"topic/partition": offset}

    def _held(self) -> dict[str, list[_File]]:
        """Files of each topic partition by offset. A footer is read once per file."""
        found: dict[str, list[_File]] = {}
        for topic in self.topics:
            chosen = fs.FileSelector(f"{self.root}/topic={topic}", recursive=True, allow_not_found=True)
            for info in self.fs.get_file_info(chosen):
                place = _PLACE.search(info.path)
                if not place:
                    continue
                if info.path not in self._files:
                    self._files[info.path] = _bounds(self.fs, info.path)
                if own := self._files[info.path]:
                    found.setdefault(f"{place[1]}/{place[2]}", []).append(own)
        return {k: sorted(v, key=lambda f: f.first) for k, v in found.items()}

    def initialOffset(self) -> dict:
        held = self._held()
        if self.start == "latest":
            return {k: max(f.last for f in v) + 1 for k, v in held.items()}
        first = {k: v[0].first for k, v in held.items()}
        return first if self.start == "earliest" else first | json.loads(self.start)

    def latestOffset(self) -> dict:
        return {k: max(f.last for f in v) + 1 for k, v in self._held().items()}

    def partitions(self, start: dict, end: dict) -> Sequence[Slice]:
        held, out = self._held(), []
        for place, until in sorted(end.items()):
            own = held.get(place, [])
            # A partition that came after the start is read from its first message.
            since = start.get(place, own[0].first if own else until)
            oldest = own[0].first if own else until
            if since < min(oldest, until) and self.strict:
                raise RuntimeError(f"messages {since} to {min(oldest, until) - 1} of {place} are gone; see failOnDataLoss")
            topic, number = place.rsplit("/", 1)
            for at in range(max(since, oldest), until, self.per_task):
                to = min(until, at + self.per_task)
                files = [f.path for f in own if f.first < to and f.last >= at]
                out.append(Slice(topic, int(number), at, to, files))
        return out

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        for path in partition.files:
            with self.fs.open_input_file(path) as file:
                for batch in pq.ParquetFile(file).iter_batches(columns=["key", "value", "offset", "timestamp"]):
                    offset = batch.column(2)
                    inside = pc.and_(pc.greater_equal(offset, partition.start), pc.less(offset, partition.end))
                    batch = batch.filter(inside)
                    n = batch.num_rows
                    if n:
                        columns = [
                            batch.column(0),
                            batch.column(1),
                            pa.array([partition.topic] * n),
                            pa.array([partition.partition] * n, pa.int32()),
                            batch.column(2),
                            batch.column(3).cast(pa.timestamp("us")),
                        ]
                        yield pa.RecordBatch.from_arrays(columns, ["key", "value", "topic", "partition", "offset", "timestamp"])

    def commit(self, end: dict) -> None:
        pass


def _uri(path: str) -> str:
    """For pyarrow, which takes file:///x and plain absolute paths, and not Hadoop's file:/x."""
    return re.sub(r"^file:/(?!/)", "/", path)


def _bounds(files: fs.FileSystem, path: str) -> _File | None:
    """Least and greatest offset of a file, from its footer; None of a file without rows."""
    with files.open_input_file(path) as file:
        data = pq.ParquetFile(file).metadata
    at = [data.schema.column(i).name for i in range(data.num_columns)].index("offset")
    groups = [data.row_group(g).column(at).statistics for g in range(data.num_row_groups) if data.row_group(g).num_rows]
    return _File(path, min(s.min for s in groups), max(s.max for s in groups)) if groups else None


class TopicArchive(DataSource):
    """Options: path, subscribe (names, comma-separated), startingOffsets (earliest, latest, or JSON of
    offsets by topic/partition), failOnDataLoss, offsetsPerTask."""

    @classmethod
    def name(cls) -> str:
        return "topic_archive"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> ArchiveReader:
        return ArchiveReader(dict(self.options))


def archive_feed(spark: SparkSession, path: str, topic: str, **options: str) -> DataFrame:
    """An archived topic as a stream, with the options of ``kafka_feed``."""
    spark.dataSource.register(TopicArchive)
    return (
        spark.readStream.format("topic_archive")
        .option("path", path)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "false")
        .options(**options)
        .load()
    )
