"""Archived topics: offsets, restarts, lost messages, several topics."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.streaming import feed
from millrace.streaming.archive import ArchiveReader, archive_feed, archive_topic


def add(spark, path, topic, first, n, parts=3):
    rows = spark.range(first, first + n).selectExpr(
        f"id % {parts} AS partition", f"id div {parts} AS offset", "concat('m', id) AS value", "timestamp_ntz'2024-01-01' AS timestamp"
    )
    archive_topic(rows, path, topic)


def drain(stream, root):
    feed.finish(
        stream.select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset")
        .writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/cp")
        .trigger(**feed.DRAIN).start(),
        timeout=120,
    )
    return stream.sparkSession.read.parquet(f"{root}/out")


def test_a_restart_goes_on_from_the_offsets(spark, rows, tmp_path):
    path, root = str(tmp_path / "archive"), str(tmp_path / "run")
    add(spark, path, "orders", 0, 30)
    add(spark, path, "others", 0, 5)
    got = drain(archive_feed(spark, path, "orders", offsetsPerTask="4"), root)
    assert rows(got, "value", "topic") == sorted((f"m{i}", "orders") for i in range(30))
    assert rows(got.groupBy("partition").agg(F.min("offset"), F.max("offset"))) == [(0, 0, 9), (1, 0, 9), (2, 0, 9)]
    add(spark, path, "orders", 30, 13, parts=3)
    got = drain(archive_feed(spark, path, "orders"), root)
    assert rows(got, "value") == sorted((f"m{i}",) for i in range(43))
    assert drain(archive_feed(spark, path, "orders"), root).count() == 43


def test_several_topics_and_starts(spark, tmp_path):
    path = str(tmp_path / "archive")
    add(spark, path, "a", 0, 9)
    add(spark, path, "b", 0, 4, parts=1)
    assert drain(archive_feed(spark, path, "a,b"), str(tmp_path / "both")).count() == 13
    begin = '{"a/0": 2, "a/1": 3}'
    assert drain(archive_feed(spark, path, "a", startingOffsets=begin), str(tmp_path / "some")).count() == 1 + 0 + 3


def test_lost_messages(spark, tmp_path):
    path = str(tmp_path / "archive")
    add(spark, path, "a", 0, 10, parts=1)
    add(spark, path, "a", 10, 10, parts=1)
    reader = ArchiveReader({"path": path, "subscribe": "a"})
    start, end = reader.initialOffset(), reader.latestOffset()
    assert (start, end) == ({"a/0": 0}, {"a/0": 20})
    for file in Path(path).rglob("*.parquet"):
        if reader._files[str(file)].last < 10:
            file.unlink()
    with pytest.raises(RuntimeError, match="0 to 9 of a/0 are gone"):
        reader.partitions(start, end)
    lenient = ArchiveReader({"path": path, "subscribe": "a", "failOnDataLoss": "false", "offsetsPerTask": "3"})
    slices = lenient.partitions(start, end)
    assert [(s.start, s.end) for s in slices] == [(10, 13), (13, 16), (16, 19), (19, 20)]
    assert [v.as_py() for s in slices for b in lenient.read(s) for v in b.column(1)] == [f"m{i}".encode() for i in range(10, 20)]
    assert ArchiveReader({"path": path, "subscribe": "a", "startingOffsets": "latest"}).initialOffset() == {"a/0": 20}
    assert ArchiveReader({"path": path, "subscribe": "nobody"}).latestOffset() == {}


def test_changes_land_from_an_archive_as_from_files(spark, rows, tmp_path):
    values = spark.range(50).selectExpr(
        "id % 2 AS partition", "id div 2 AS offset",
        """CASE WHEN id % 9 = 0 THEN '{}' ELSE concat('{"payload": {"after": "{}", "op": "c", "source": {"ts_ms": ', id, '}}}') END AS value""",
    )
    path = str(tmp_path / "archive")
    archive_topic(values, path, "orders")
    values.write.parquet(str(tmp_path / "files"))
    clock = F.lit("2024-02-01 03:04:05").cast("timestamp_ntz")
    feeds = {"archive": archive_feed(spark, path, "orders"), "files": feed.file_feed(spark, str(tmp_path / "files"))}
    queries = feed.land_topics(feeds, str(tmp_path), carry=["offset"], processing_time=clock, trigger=feed.DRAIN)
    feed.finish(*queries.values(), timeout=120)
    for layer, n in (("bronze", 44), ("rejects", 6)):
        one, two = (spark.read.parquet(str(tmp_path / layer / name)) for name in feeds)
        assert rows(one.drop("year", "month", "day")) == rows(two.drop("year", "month", "day")) and one.count() == n
