"""Which rows of near-duplicate groups stay where ids are null or repeated."""

from __future__ import annotations

import pytest

from millrace.llm import nearcopies, simhash


def words(name, n=60):
    return " ".join(f"{name}{k}" for k in range(n))


@pytest.mark.parametrize("drop", [simhash.drop_near_duplicates, nearcopies.drop_near_copies])
def test_rows_are_told_apart_by_text(spark, drop):
    a = [words(f"n{k}x") for k in range(12)]
    rows = [(None, t) for t in a] + [(None, a[0])]
    # Each id from 100 on has a copy of a smaller id's text, and a text of its own.
    for k in range(8):
        rows += [(k, words(f"c{k}y")), (100 + k, words(f"c{k}y")), (100 + k, words(f"u{k}z"))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.text, r.doc_id is None, r.doc_id) for r in drop(df).collect())
    want = [(t, True, None) for t in a] + [(words(f"c{k}y"), False, k) for k in range(8)]
    assert got == sorted(want + [(words(f"u{k}z"), False, 100 + k) for k in range(8)])


def test_unlike_texts_of_one_id_stay(spark):
    rows = [(1, words("a")), (1, words("b")), (1, words("b")), (2, words("a"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in nearcopies.drop_near_copies(df).collect()) == sorted(set(rows[:2]))
