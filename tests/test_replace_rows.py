"""Whole rows replaced by key: same rows as the upsert, and only keys are shuffled."""

from __future__ import annotations

import pytest

from millrace.operators import merge
from tests.test_skew import final_plan

DDL = "a string, b long, v string"


def test_same_rows_as_upsert(spark):
    target = spark.createDataFrame([("x", 1, "old"), ("x", 2, "old"), (None, 1, "old"), ("y", None, "old")], DDL)
    source = spark.createDataFrame([("x", 1, "new"), (None, 1, "new"), ("z", None, "new"), ("y", 1, None)], DDL)
    got = merge.replace_rows(target, source, ["a", "b"]).collect()
    want = merge.upsert(target, source, ["a", "b"]).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str) and len(got) == 6
    none = source.limit(0)
    assert merge.replace_rows(target, none, ["a", "b"]).count() == 4 and merge.replace_rows(none, source, ["a", "b"]).count() == 4


def test_repeated_source_key_fails(spark):
    target = spark.createDataFrame([("x", 1, "old")], DDL)
    source = spark.createDataFrame([("x", 1, "new"), ("x", 1, "newer")], DDL)
    with pytest.raises(Exception, match="several rows for one key"):
        merge.replace_rows(target, source, ["a", "b"]).collect()


def test_a_source_with_all_keys_shuffles_no_values(spark):
    rows = spark.range(5000).selectExpr("cast(id AS string) AS a", "id AS b", "sha2(cast(id AS string), 512) AS v")
    given = rows.selectExpr("a", "b", "'new' AS v")
    assert "Exchange hashpartitioning" in final_plan(merge.upsert(rows, given, ["a", "b"], plan="outer"))
    assert "Exchange hashpartitioning" not in final_plan(merge.replace_rows(rows, given, ["a", "b"], unique=True))
