"""Queries that read features or scores in several jobs read stored ones, and feeds are cut into files."""

from __future__ import annotations

import pytest

from millrace.session import configure
from millrace.suite import queries
from millrace.suite.views import Source
from tests.conftest import TESTDATA
from tests.test_skew import settings


@pytest.mark.parametrize("name", ["union_all", "ml_report_stored", "ml_train_predict"])
def test_features_are_made_once(spark, name):
    """What the result is computed from no longer includes the facts."""
    files = queries.QUERIES[name](spark, str(TESTDATA)).inputFiles()
    assert files and not any("fact_sales" in f or "fact_reviews" in f for f in files)


def test_feed_is_cut_without_a_shuffle(spark, tmp_path):
    configure(spark)
    with settings(spark, {"spark.sql.shuffle.partitions": "7"}):
        s = Source(spark, str(TESTDATA))
        rows = s.order_feed().coalesce(1)
        written = spark.read.parquet(queries._as_files(s, rows, "cut"))
        assert len(written.inputFiles()) == 7 and written.count() == rows.count()
        # Of one task; a shuffle would have dealt neighbours to different files.
        first = written.where("_metadata.file_name LIKE '%c000.%' OR _metadata.file_name LIKE '%c000-%'").count()
        assert 0 < first < rows.count()
