from datetime import datetime

import pytest

from millrace.sources import landing, readers
from millrace.sources.tables import SnapshotTable, overwrite_and_register


def test_csv_with_bom_blank_and_duplicate_rows(spark, rows, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_bytes(b"\xef\xbb\xbfname,english\nauto,car\n,\nauto,car\nmesa,\n")
    df = readers.read_csv(spark, str(path), "name string, english string")
    assert rows(landing.without_noise(df)) == [("auto", "car"), ("mesa", None)]


def test_load_once(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    assert landing.load_once(spark.range(0), table)
    assert landing.load_once(spark.range(3), table)  # an empty table is loaded again
    assert not landing.load_once(spark.range(9), table)
    assert table.read().count() == 3


def test_row_counts(spark, rows):
    counts = readers.row_counts({"b": spark.range(2), "a": spark.range(3)})
    assert rows(counts) == [("TOTAL", 5), ("a", 3), ("b", 2)]


def test_full_extract_overwrites(spark, tmp_path):
    path = str(tmp_path / "full")
    landing.extract_full(spark.range(9), path, "t")
    done = landing.extract_full(spark.range(4), path, "t")
    assert done["row_count"] == 4 and done["columns"] == ["id"] and done["mode"] == "full"
    assert spark.read.parquet(path).count() == 4


def test_incremental_extract_and_watermark(spark, rows, tmp_path):
    path, store = str(tmp_path / "inc"), landing.WatermarkStore(spark, str(tmp_path / "marks"))
    times = [datetime(2018, 1, d) for d in (1, 2, 3)]
    source = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "id int, ts timestamp_ntz")

    def run(df, day):
        done = landing.extract_incremental(df, path, "t", "ts", store.get("t"), datetime(2018, 2, day))
        store.advance(done)
        return done

    assert store.get("t") is None
    assert run(source.where("id < 2"), 1)["row_count"] == 2
    assert store.get("t") == "2018-01-02 00:00:00"
    assert run(source, 2)["row_count"] == 1  # strictly newer only
    assert run(source, 3) == {"table": "t", "mode": "incremental", "row_count": 0, "status": "skipped"}
    assert store.get("t") == "2018-01-03 00:00:00"
    landed = spark.read.parquet(path)
    assert rows(landed, "id", "year", "month", "day") == [(0, 2018, 2, 1), (1, 2018, 2, 1), (2, 2018, 2, 2)]


def test_watermark_filter_reaches_the_scan(spark, plan_of, tmp_path):
    path = str(tmp_path / "p")
    spark.sql("SELECT timestamp_ntz'2018-01-01' AS ts, 1 AS a, 2 AS b").write.parquet(path)
    df = landing.newer_than(spark.read.parquet(path), "ts", "2018-01-01 00:00:00").select("a")
    scan = next(line for line in plan_of(df).splitlines() if "FileScan" in line)
    assert "GreaterThan(ts" in scan and "b:" not in scan


def test_snapshot_versions(spark, rows, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        table.read()
    table.write(spark.range(1))
    table.write(table.read().unionAll(spark.range(5, 6)), tag="q-0")  # reads what it replaces
    assert rows(table.read()) == [(0,), (5,)]
    assert table.snapshots() == {1: None, 2: "q-0"} and table.has_tag("q-0")
    (tmp_path / "t" / "v=00000002.q-0" / "_SUCCESS").unlink()  # as after a crash
    assert rows(table.read()) == [(0,)] and not table.has_tag("q-0")
    for _ in range(3):
        table.write(spark.range(2))
    table.vacuum()
    assert len(table.snapshots()) == 2 and table.read().count() == 2


def test_overwrite_and_register(spark, tmp_path):
    for n in (3, 4):
        overwrite_and_register(spark, spark.range(n), str(tmp_path / "m"), "reg_db", "numbers")
        assert spark.sql("SELECT count(*) FROM reg_db.numbers").first()[0] == n


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from millrace import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.shared_dir(Session(), "x")
    assert session.shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


class _Recorder:
    """Stands in for a session's reader, as no database is at hand: keeps the options of each read."""

    def __init__(self, first=None):
        self.reads, self._first = [], first

    @property
    def read(self):
        self.reads.append({})
        return self

    def format(self, _):
        return self

    def option(self, key, value):
        self.reads[-1][key] = value
        return self

    def options(self, **more):
        self.reads[-1].update(more)
        return self

    def load(self):
        return self

    def first(self):
        return self._first


def test_jdbc_slices_from_the_command_line():
    from millrace.__main__ import parser, slices
    from millrace.jobs import jdbc_source

    line = "extract --root r --table_name orders --url u --partition_column id --slices 8".split()
    given = parser().parse_args([*line, "--bounds", "1", "9"])
    fake = _Recorder()
    jdbc_source(fake, "u", **slices(given))("orders")
    assert fake.reads == [
        {"url": "u", "dbtable": "orders", "fetchsize": "10000", "partitionColumn": "id", "lowerBound": "1", "upperBound": "9", "numPartitions": "8"}
    ]
    asked = _Recorder(first=(3, 70))
    jdbc_source(asked, "u", **slices(parser().parse_args(line)))("orders")
    assert "MIN(id)" in asked.reads[0]["dbtable"] and "partitionColumn" not in asked.reads[0]
    assert (asked.reads[1]["lowerBound"], asked.reads[1]["upperBound"]) == ("3", "70")
    empty = _Recorder(first=(None, None))
    jdbc_source(empty, "u", **slices(parser().parse_args(line)))("orders")
    assert "partitionColumn" not in empty.reads[1]
