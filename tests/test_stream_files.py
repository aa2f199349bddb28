"""What a drained feed leaves on disk."""

from __future__ import annotations

from pathlib import Path

from millrace.sources.tables import PartitionedTable
from millrace.suite import queries
from millrace.suite.views import Source
from tests.conftest import TESTDATA


def test_landed_feed_leaves_compressed_bronze_only(spark, monkeypatch):
    feeds, as_files = [], queries._as_files

    def kept(*args):
        feeds.append(as_files(*args))
        return feeds[-1]

    monkeypatch.setattr(queries, "_as_files", kept)
    source = Source(spark, str(TESTDATA))
    feed = source.change_feed()
    bronze = queries._landed(source, feed, "users")
    assert spark.read.parquet(bronze).count() == feed.count()
    files = [p.name for p in Path(bronze.removeprefix("file:")).rglob("*.parquet")]
    assert files and all(".zstd." in name for name in files)
    assert len(feeds) == 1 and not Path(feeds[0].removeprefix("file:")).exists()


def test_merged_table_is_compressed_alike(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), ["k"], 2)
    table.write(spark.range(20).selectExpr("cast(id AS string) AS k"))
    names = [p.name for p in (tmp_path / "t").rglob("*.parquet")]
    assert names and all(".zstd." in name for name in names) and table.read().count() == 20
