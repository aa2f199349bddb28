"""Micro-batch merge of landed files into a partitioned table."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.cleaning import clean
from millrace.operators.dedup import latest_per_key
from millrace.operators.merge import ACTION, merge_into
from millrace.sources.tables import PARTS, PartitionedTable, SnapshotTable
from millrace.streaming.feed import DRAIN

logger = logging.getLogger(__name__)

# Order of changes to one key; kept in the table so that a change that arrives
# late, in a later batch, does not replace a newer row.
CHANGE_TIME = "_ts_ms"
CHANGE_SEQUENCE = "_sequence"


def change_rows(
    changes: DataFrame,
    record_ddl: str,
    keys: Sequence[str],
    entity: str | None = None,
    sequence: str | None = None,
) -> DataFrame:
    """Latest state per key from landed changes; a delete becomes an inactive row.

    Keys are cleaned before they are compared. ``sequence`` breaks ties of
    ``ts_ms`` (an offset in the feed). Changes without a key (``unreadable_changes``) are left out.
    """
    order = {CHANGE_TIME: F.col("ts_ms")}
    if sequence:
        order[CHANGE_SEQUENCE] = F.col(sequence)
    parsed = changes.select(
        F.from_json("raw_record", record_ddl).alias("record"),
        (F.col("op") != "d").alias("is_active"),
        *[column.alias(name) for name, column in order.items()],
    ).select("record.*", "is_active", *order)
    parsed = parsed.where(~_any_null([F.col(k) for k in keys]))
    cleaned = clean(parsed, entity or "")
    return latest_per_key(cleaned, keys, list(order))


def unreadable_changes(changes: DataFrame, record_ddl: str, keys: Sequence[str]) -> DataFrame:
    """Changes whose record can't be parsed or has no key: they can't be applied to any row."""
    record = F.from_json("raw_record", record_ddl)
    return changes.where(_any_null([record[k] for k in keys]))


def _any_null(columns: Sequence[Column]) -> Column:
    return reduce(Column.__or__, [c.isNull() for c in columns])


def snapshot_rows(
    rows: DataFrame, keys: Sequence[str], latest_by: str, entity: str | None = None
) -> DataFrame:
    """Latest cleaned row per key of a full or incremental extract, marked active."""
    cleaned = clean(rows, entity or "").withColumn("is_active", F.lit(True))
    return latest_per_key(cleaned, keys, [latest_by])


def open_table(
    spark: SparkSession, path: str, keys: Sequence[str], buckets: int | None = None
) -> PartitionedTable:
    """The table that streams merge into; ``buckets`` is the number of its partitions."""
    return PartitionedTable(spark, path, keys, buckets or PARTS)


def apply_rows(
    table: SnapshotTable | PartitionedTable,
    rows: DataFrame,
    keys: Sequence[str],
    newer_by: Sequence[str] | None = None,
    tag: str | None = None,
    **merge_options,
) -> dict[str, int]:
    """Create the table from ``rows`` or merge them in; returns the rows per action.

    The counts are observed while the result is written.
    """
    seen = Observation()
    table.recover()
    if table.exists():
        # Rows that are absent from a snapshot can be anywhere in the table.
        held = table.read() if merge_options.get("absent") else table.read_for(rows)
        merged = merge_into(held, rows, keys, newer_by=newer_by, **merge_options)
    else:
        merged = rows.withColumn(ACTION, F.lit("insert"))
    actions = ("insert", "update", "soft_delete", "keep")
    observed = merged.observe(
        seen, *[F.count_if(F.col(ACTION) == a).alias(a) for a in actions]
    )
    table.write(observed.drop(ACTION), tag=tag)
    table.vacuum()
    return seen.get


def merge_stream(
    landed: DataFrame,
    table_path: str,
    checkpoint: str,
    keys: Sequence[str],
    to_rows: Callable[[DataFrame], DataFrame],
    newer_by: Sequence[str] | None = None,
    trigger: Mapping[str, object] = DRAIN,
    buckets: int | None = None,
    set_aside: Callable[[DataFrame, int], None] | None = None,
    unique: bool = False,
) -> StreamingQuery:
    """Merge each micro-batch into the table, exactly once.

    set_aside: is given each batch and its number before the merge, to store what
    can't be merged; it may see a batch again when that is replayed.

    unique: ``to_rows`` gives one row per key.

    buckets: number of partitions of the table; a batch rewrites those that hold keys of it.

    What is written for a batch is tagged with the query's id (kept in the
    checkpoint) and the batch number. When a batch is replayed after a failure
    and its rows were stored completely, these are moved into the table if they are not there yet,
    and the batch is skipped; otherwise it runs again over the table before it.
    """

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table = open_table(spark, table_path, keys, buckets)
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        tag = f"{query_id}-{batch_id}"
        table.recover()
        if table.has_tag(tag):
            return
        if set_aside:
            set_aside(batch, batch_id)
        # As large as the stream's batch limit allows; cached, on disk where memory is short,
        # because the merge reads it more than once and to let Spark plan with its real size.
        rows = to_rows(batch).persist()
        try:
            if rows.count() == 0:
                return
            done = apply_rows(table, rows, keys, newer_by, tag, unique=unique)
            logger.info("batch %s: %s", batch_id, done)
        finally:
            rows.unpersist()

    return (
        landed.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def merge_change_stream(
    landed: DataFrame,
    table_path: str,
    checkpoint: str,
    keys: Sequence[str],
    record_ddl: str,
    entity: str | None = None,
    sequence: str | None = None,
    rejects: str | None = None,
    **options,
) -> StreamingQuery:
    """Apply a landed change feed. Changes without a readable key go to ``rejects``, a folder per
    batch, which a replay of the batch writes anew."""

    def set_aside(batch: DataFrame, batch_id: int) -> None:
        lost = unreadable_changes(batch, record_ddl, keys)
        lost.write.mode("overwrite").parquet(f"{rejects}/batch={batch_id}")

    newer_by = [CHANGE_TIME, *([CHANGE_SEQUENCE] if sequence else [])]
    return merge_stream(
        landed,
        table_path,
        checkpoint,
        keys,
        lambda batch: change_rows(batch, record_ddl, keys, entity, sequence),
        newer_by,
        set_aside=set_aside if rejects else None,
        unique=True,
        **options,
    )


def merge_row_stream(
    landed: DataFrame,
    table_path: str,
    checkpoint: str,
    keys: Sequence[str],
    latest_by: str,
    entity: str | None = None,
    **options,
) -> StreamingQuery:
    """Apply landed incremental extracts."""
    return merge_stream(
        landed,
        table_path,
        checkpoint,
        keys,
        lambda batch: snapshot_rows(batch, keys, latest_by, entity),
        [latest_by],
        unique=True,
        **options,
    )
