"""Change feed: sources, envelope parsing, landing as partitioned Parquet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.streaming.supervise import Supervisor

# Fixed value: the message layout of the change feed.
ENVELOPE = (
    "payload STRUCT<before: STRING, after: STRING, op: STRING, source: STRUCT<ts_ms: BIGINT>>"
)

EVERY_MINUTE = {"processingTime": "1 minute"}
DRAIN = {"availableNow": True}


def kafka_feed(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Topic as a stream. The Kafka package must be on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "false")
        .options(**options)
        .load()
    )


def file_feed(
    spark: SparkSession,
    path: str,
    schema: str | None = None,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Folder of Parquet files as a stream; without a schema it is taken from the files present.

    max_files, max_bytes: how much a batch takes at most, besides its first file.
    """
    reader = spark.readStream.schema(schema or spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)


def parse_envelope(feed: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``raw_record``, ``op`` and ``ts_ms`` of each message, plus the ``carry`` columns.

    A delete has no ``after``, so its record is taken from ``before``.
    """
    data = F.from_json(F.col("value").cast("string"), ENVELOPE)
    return feed.select(data.alias("data"), *carry).select(
        F.coalesce("data.payload.after", "data.payload.before").alias("raw_record"),
        F.col("data.payload.op").alias("op"),
        F.col("data.payload.source.ts_ms").alias("ts_ms"),
        *carry,
    )


def is_usable() -> Column:
    """False for tombstones and messages that are not a change envelope."""
    return F.col("raw_record").isNotNull() & F.col("op").isNotNull()


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(is_usable())


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where(~is_usable())


def with_processing_date(df: DataFrame, processing_time: Column | None = None) -> DataFrame:
    """Add ``processing_time`` (now, unless given) and its ``year``, ``month``, ``day`` as text."""
    now = F.current_timestamp() if processing_time is None else processing_time
    return df.select("*", now.alias("processing_time")).select(
        "*",
        F.date_format("processing_time", "yyyy").alias("year"),
        F.date_format("processing_time", "MM").alias("month"),
        F.date_format("processing_time", "dd").alias("day"),
    )


def land(
    feed: DataFrame,
    path: str,
    checkpoint: str,
    *,
    carry: Sequence[str] = (),
    processing_time: Column | None = None,
    trigger: Mapping[str, object] = EVERY_MINUTE,
) -> StreamingQuery:
    """Append the usable changes of a feed to ``year=/month=/day=`` folders."""
    changes = with_processing_date(accepted(parse_envelope(feed, carry)), processing_time)
    return _append(changes, path, checkpoint, trigger)


def land_rejected(
    feed: DataFrame,
    path: str,
    checkpoint: str,
    *,
    carry: Sequence[str] = (),
    processing_time: Column | None = None,
    trigger: Mapping[str, object] = EVERY_MINUTE,
) -> StreamingQuery:
    """Append what ``land`` leaves out, for inspection."""
    changes = with_processing_date(rejected(parse_envelope(feed, carry)), processing_time)
    return _append(changes, path, checkpoint, trigger)


def _append(changes: DataFrame, path: str, checkpoint: str, trigger) -> StreamingQuery:
    return (
        changes.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        # Records are JSON text, of which zstd leaves a good deal less than Parquet's default.
        .option("compression", "zstd")
        .partitionBy("year", "month", "day")
        .trigger(**trigger)
        .start()
    )


def land_topics(
    feeds: Mapping[str, DataFrame], root: str, **options
) -> dict[str, StreamingQuery]:
    """Two queries per feed, all in this session: the usable changes under the feed's name, and
    what they leave out under "rejects/name". Wait with ``finish``."""
    queries = {}
    for name, stream in feeds.items():
        queries[name] = land(stream, f"{root}/bronze/{name}", f"{root}/checkpoints/bronze/{name}", **options)
        queries[f"rejects/{name}"] = land_rejected(
            stream, f"{root}/rejects/{name}", f"{root}/checkpoints/rejects/{name}", **options
        )
    return queries


def finish(*queries: StreamingQuery, timeout: int | None = None) -> None:
    """Wait for draining queries. When one fails, or they did not end within ``timeout`` seconds,
    all are stopped and that is raised."""
    with Supervisor(SparkSession.active()) as supervisor:
        supervisor.finish(*queries, timeout=timeout)
