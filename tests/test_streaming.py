import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.operators import merge
from millrace.sources import tables
from millrace.streaming import feed, silver
from millrace.streaming.supervise import Supervisor

RECORD = "order_id STRING, order_status STRING"
BRONZE = "raw_record string, op string, ts_ms long, seq long"


def message(op, key, status, ts, gone=False):
    record = {"order_id": key, "order_status": status}
    side = "before" if gone else "after"
    return json.dumps({"payload": {side: record, "op": op, "source": {"ts_ms": ts}}})


def change(op, key, status, ts, seq):
    return (json.dumps({"order_id": key, "order_status": status}), op, ts, seq)


def test_envelope_and_rejects(spark, rows):
    values = [message("c", "1", "new", 5), message("d", "2", "old", 6, gone=True), None, "not json", "{}"]
    parsed = feed.parse_envelope(spark.createDataFrame([(v,) for v in values], "value string"))
    assert rows(feed.accepted(parsed), "op", "ts_ms") == [("c", 5), ("d", 6)]
    assert json.loads(feed.accepted(parsed).where("op = 'd'").first().raw_record)["order_id"] == "2"
    assert feed.rejected(parsed).count() == 3


def test_envelope_accepts_binary_values(spark):
    df = spark.createDataFrame([(message("c", "1", "n", 5).encode(),)], "value binary")
    assert feed.parse_envelope(df).first().op == "c"


class Feed:
    """A bronze folder that grows, and the table merged from it."""

    def __init__(self, spark, root, buckets=None):
        self.spark, self.root, self.buckets = spark, str(root), buckets

    def add(self, *changes):
        self.spark.createDataFrame(list(changes), BRONZE).coalesce(1).write.mode("append").parquet(
            f"{self.root}/bronze"
        )

    def drain(self, sequence="seq"):
        stream = feed.file_feed(self.spark, f"{self.root}/bronze", BRONZE, max_files=1)
        query = silver.merge_change_stream(
            stream, f"{self.root}/silver", f"{self.root}/checkpoint", ["order_id"], RECORD,
            "orders", sequence, buckets=self.buckets,
        )
        feed.finish(query, timeout=120)
        return self.table

    @property
    def table(self):
        return silver.open_table(self.spark, f"{self.root}/silver", ["order_id"], self.buckets)


def test_changes_drain_restart_and_late_arrival(spark, rows, tmp_path):
    f = Feed(spark, tmp_path)
    f.add(change("c", "1", " New ", 10, 1), change("c", "2", "new", 11, 2), change("u", "2", "PAID", 12, 3))
    state = rows(f.drain().read(), "order_id", "order_status", "is_active")
    assert state == [("1", "new", True), ("2", "paid", True)]
    f.add(change("d", "1", "new", 20, 4), change("u", "2", "stale", 5, 5))
    f.drain()
    wanted = [("1", "new", False), ("2", "paid", True)]
    assert rows(f.table.read(), "order_id", "order_status", "is_active") == wanted
    snapshots = f.table.snapshots()
    f.drain()  # nothing new
    assert f.table.snapshots() == snapshots
    f.add(change("c", "1", "back", 30, 6))
    assert rows(f.drain().read(), "order_id", "order_status", "is_active")[0] == ("1", "back", True)


def test_replayed_batch_is_applied_once(spark, rows, tmp_path):
    f = Feed(spark, tmp_path)
    f.add(change("c", "1", "new", 10, 1))
    f.drain()
    before = f.table.snapshots()
    commit = tmp_path / "checkpoint" / "commits" / "0"
    commit.unlink()  # the driver died after the write and before the commit
    for crc in commit.parent.glob(".0.crc"):
        crc.unlink()
    f.drain()
    assert f.table.snapshots() == before


@pytest.mark.parametrize(("cuts", "buckets"), [(1, None), (3, None), (3, 4)])
def test_state_does_not_depend_on_the_cut_into_batches(spark, rows, tmp_path, cuts, buckets):
    changes = [
        change("d" if (i * 7) % 11 == 0 else "u", str((i * i) % 5), f"s{i}", (i * 13) % 40, i)
        for i in range(60)
    ]
    f = Feed(spark, tmp_path / str(cuts), buckets)
    for c in range(cuts):
        f.add(*changes[c::cuts])
    last = {}
    for raw, op, ts, seq in changes:
        key = json.loads(raw)["order_id"]
        if key not in last or (ts, seq) > last[key][:2]:
            last[key] = (ts, seq, json.loads(raw)["order_status"], op != "d")
    wanted = sorted((k, v[2], v[3]) for k, v in last.items())
    assert rows(f.drain().read(), "order_id", "order_status", "is_active") == wanted


def test_row_stream_keeps_the_newest(spark, rows, tmp_path):
    ddl = "review_id string, order_id string, review_score string, review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz, last_modified_date int"
    stamp = "timestamp_ntz'2018-01-01'"
    for part in ([("r1", "o", "5", 1)], [("r1", "o", "3", 2), (" r2", "o", "x", 1)]):
        df = spark.createDataFrame(part, "review_id string, order_id string, review_score string, last_modified_date int")
        df.selectExpr("review_id", "order_id", "review_score", f"{stamp} AS review_creation_date",
                      f"{stamp} AS review_answer_timestamp", "last_modified_date").write.mode("append").parquet(
            str(tmp_path / "bronze"))
    query = silver.merge_row_stream(
        feed.file_feed(spark, str(tmp_path / "bronze"), ddl, max_files=1), str(tmp_path / "silver"),
        str(tmp_path / "checkpoint"), ["review_id", "order_id"], "last_modified_date", "order_reviews",
    )
    feed.finish(query, timeout=120)
    table = silver.open_table(spark, str(tmp_path / "silver"), ["review_id", "order_id"])
    got = rows(table.read(), "review_id", "review_score", "is_active")
    assert got == [("r1", 3, True), ("r2", None, True)]


def test_two_topics_and_rejects_land(spark, rows, tmp_path):
    for name in ("a", "b"):
        spark.createDataFrame([(message("c", name, "n", 1),), (None,)], "value string").write.parquet(
            str(tmp_path / "in" / name)
        )
    feeds = {n: feed.file_feed(spark, str(tmp_path / "in" / n), "value string") for n in ("a", "b")}
    clock = F.lit("2024-02-01 03:04:05").cast("timestamp_ntz")
    queries = feed.land_topics(feeds, str(tmp_path), processing_time=clock, trigger=feed.DRAIN)
    rejects = feed.land_rejected(
        feeds["a"], str(tmp_path / "rejects"), str(tmp_path / "cp-rejects"), trigger=feed.DRAIN
    )
    feed.finish(*queries.values(), rejects, timeout=120)
    for name in ("a", "b"):
        landed = spark.read.parquet(str(tmp_path / "bronze" / name))
        assert rows(landed, "op", "year", "month", "day") == [("c", 2024, 2, 1)]
    assert spark.read.parquet(str(tmp_path / "rejects")).count() == 1


def test_failed_stream_raises(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "in"))

    def fail(batch, _):
        raise ValueError("no")

    query = (
        feed.file_feed(spark, str(tmp_path / "in")).writeStream.foreachBatch(fail)
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    with pytest.raises(Exception):
        feed.finish(query, timeout=60)


def files(table):
    """Names of the data files of each partition."""
    return {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in Path(table.rows).glob("part_of_key=*")}


@pytest.mark.parametrize("buckets", [None, 8])
def test_a_small_batch_rewrites_the_partitions_it_touches(spark, rows, tmp_path, buckets):
    f = Feed(spark, tmp_path, buckets)
    f.add(*[change("c", str(i), "new", 1, i) for i in range(300)])
    f.drain()
    first = files(f.table)
    assert len(first) == (buckets or 16) and f.table.read().count() == 300
    f.add(change("u", "7", "paid", 2, 400), change("c", "new", "new", 2, 401))
    f.drain()
    second = files(f.table)
    assert 1 <= sum(second[p] != first[p] for p in second) <= 2 and second.keys() == first.keys()
    wanted = {str(i): "new" for i in range(300)} | {"7": "paid", "new": "new"}
    assert rows(f.table.read(), "order_id", "order_status") == sorted(wanted.items())
    # Rows of batches that are in the table are not kept a second time.
    assert not list(Path(f.table.path, "batches").glob("*/part_of_key=*"))


def test_a_write_cut_short_is_finished_once(spark, rows, tmp_path):
    """The driver dies after some partitions were deleted for the move, and the batch is replayed."""
    f = Feed(spark, tmp_path)
    f.add(*[change("c", str(i), "new", 1, i) for i in range(100)])
    f.drain()
    table = f.table
    changed = table.read().where("order_id < '5'").withColumn("order_status", F.lit("paid"))
    merged = merge.upsert(table.read(), changed, ["order_id"])

    class Dies(tables.PartitionedTable):
        def _apply(self, folder):
            raise RuntimeError("gone")

    with pytest.raises(RuntimeError):
        Dies(spark, table.path, ["order_id"], table.parts).write(merged, "again")
    for folder in list(Path(table.rows).glob("part_of_key=*"))[:3]:
        for file in folder.iterdir():
            file.unlink()
        folder.rmdir()
    assert not table.has_tag("again")
    table.recover()
    assert table.has_tag("again")
    wanted = [(str(i), "paid" if str(i) < "5" else "new") for i in range(100)]
    assert rows(table.read(), "order_id", "order_status") == sorted(wanted)
    before = files(table)
    table.recover()
    assert files(table) == before


def test_merge_reads_only_touched_partitions(spark, tmp_path, plan_of):
    table = silver.open_table(spark, str(tmp_path / "t"), ["k"])
    silver.apply_rows(table, spark.range(1000).selectExpr("id AS k", "'a' AS v"), ["k"])
    plan = plan_of(table.read_for(spark.range(5, 6).selectExpr("id AS k")))
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_bucket_count_is_fixed(spark, tmp_path):
    f = Feed(spark, tmp_path, buckets=4)
    f.add(change("c", "1", "new", 1, 1))
    f.drain()
    with pytest.raises(ValueError):
        silver.open_table(spark, f"{f.root}/silver", ["order_id"], 5).read()


def test_new_column_of_a_later_batch(spark, rows, tmp_path):
    table = silver.open_table(spark, str(tmp_path / "t"), ["k"], 4)
    silver.apply_rows(table, spark.range(20).selectExpr("id AS k", "'a' AS v"), ["k"])
    silver.apply_rows(table, spark.range(3, 4).selectExpr("id AS k", "'b' AS v", "1 AS w"), ["k"])
    assert rows(table.read().where("w = 1")) == [(3, "b", 1)]
    assert table.read().count() == 20


def _slow(batch, _):
    batch.count()
    time.sleep(0.2)


def _fail(batch, _):
    raise ValueError("second topic is broken")


def _started(spark, root, name, work, trigger):
    spark.range(5).write.mode("overwrite").parquet(f"{root}/{name}-in")
    stream = feed.file_feed(spark, f"{root}/{name}-in").writeStream.foreachBatch(work)
    return stream.option("checkpointLocation", f"{root}/{name}-cp").trigger(**trigger).queryName(name).start()


def test_a_failure_of_the_second_topic_ends_all_at_once(spark, tmp_path):
    """The first one would go on for ever."""
    endless = {"processingTime": "200 milliseconds"}
    counts = str(tmp_path / "counts")
    with Supervisor(spark, counts) as supervisor:
        first = _started(spark, tmp_path, "first", _slow, endless)
        while not first.recentProgress:
            time.sleep(0.1)
        second = _started(spark, tmp_path, "second", _fail, endless)
        began = time.monotonic()
        with pytest.raises(Exception, match="second topic is broken"):
            supervisor.finish(first, second)
        assert time.monotonic() - began < 30
    assert not first.isActive and not second.isActive
    told = {(r.query, r.input_rows, r.failure is not None) for r in spark.read.parquet(counts).collect()}
    assert ("first", 5, False) in told and ("second", 0, True) in told


def test_rows_of_each_batch_are_counted(spark, tmp_path):
    counts = str(tmp_path / "counts")
    for n in (3, 4):
        spark.range(n).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = feed.file_feed(spark, str(tmp_path / "in"), max_files=1)
    with Supervisor(spark, counts) as supervisor:
        query = (
            stream.writeStream.foreachBatch(lambda batch, _: batch.count())
            .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        )
        assert supervisor.finish(query, names=["rows"]) == {"rows": 7}
    assert sorted(r.input_rows for r in spark.read.parquet(counts).collect()) == [3, 4]


def test_streams_that_do_not_end_in_time_are_stopped(spark, tmp_path):
    query = _started(spark, tmp_path, "endless", _slow, {"processingTime": "1 second"})
    with pytest.raises(TimeoutError):
        feed.finish(query, timeout=2)
    assert not query.isActive
