"""Ranked search against all documents scored."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import ranked
from tests.conftest import TESTDATA
from tests.llm.brute import TERM, fold

ITEMS = [
    (1, "Alpha beta gamma delta the of"),
    (2, "one two three three"),
    (2, "one two three"),
    (None, "x1 x1 W17 w18"),
    (10, None),
    (11, ""),
    (12, "nowhere-to-be-found"),
    (13, "日本 Ünïcode"),
    (14, " ".join(f"w{k}" for k in range(5000))),
]


def search(docs, items, top=10):
    terms = [(i, Counter(TERM.findall(fold(t)))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in terms), sum(c.total() for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    out = []
    for item, text in items:
        scores = []
        own = Counter(TERM.findall(fold(text)))
        for doc_id, c in terms:
            score = 0
            for t, repeats in own.items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 25 + 75 * c.total() * n_docs // n_terms
                    score += repeats * w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, k + 1, d, -s) for k, (s, _, d) in enumerate(scores[:top])]
    return out


def result(docs, items, **options):
    return sorted((tuple(r) for r in ranked.search(docs, items, **options).collect()), key=repr)


@pytest.fixture
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string").repartition(2)


def test_equals_all_scores_on_odd_rows(odd_docs, odd_rows, items):
    assert result(odd_docs, items) == sorted(search(odd_rows, ITEMS), key=repr)


@pytest.mark.parametrize("bounds", [(40, 3, 100), (ranked.BLOCK_TERMS, ranked.BLOCK_ITEMS, ranked.CELLS)])
def test_equals_all_scores_on_documents(spark, small_docs, monkeypatch, bounds):
    """With blocks of few items and batches of 16 documents, too."""
    for name, value in zip(("BLOCK_TERMS", "BLOCK_ITEMS", "CELLS"), bounds, strict=True):
        monkeypatch.setattr(ranked, name, value)
    own = spark.read.parquet(str(TESTDATA / "benchmark.parquet")).limit(12).collect()
    rows = [(r.item_id, r.text) for r in own]
    got = result(small_docs, spark.createDataFrame(rows, "item_id long, text string"))
    assert got == sorted(search([tuple(r) for r in small_docs.collect()], rows), key=repr)


def test_ties_rank_by_id(spark):
    rows = [(k, "same few words") for k in range(60, 0, -1)] + [(None, "same few words"), (5, "same few words"), (99, "others")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    items = spark.createDataFrame([("i", "few")], "item_id string, text string")
    got = ranked.search(docs, items, top=10).orderBy("rank").collect()
    assert [r.doc_id for r in got] == [1, 2, 3, 4, 5, 5, 6, 7, 8, 9] and len({r.score for r in got}) == 1


def test_repeated_documents_and_terms_of_all(spark):
    """A term that nearly all documents hold weighs little, and may weigh nothing."""
    rows = [(k, "common") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, "common")], "item_id long, text string")
    assert result(docs, items) == search(rows, [(1, "common")]) == []


def test_pieces_of_long_texts():
    text = "ab cd-" * 400_000
    counts, n = ranked.term_counts(text)
    assert n == 800_000 and counts == {b"ab": 400_000, b"cd": 400_000}


def test_groups_of_equal_masks():
    present = np.random.default_rng(1).random((500, 70)) < 0.03
    order, starts = ranked.by_mask(present)
    groups = [frozenset(order[a:b].tolist()) for a, b in zip(starts, [*starts[1:], 500], strict=True)]
    want = {}
    for k, row in enumerate(present):
        want.setdefault(row.tobytes(), set()).add(k)
    assert sorted(map(sorted, groups)) == sorted(map(sorted, want.values()))


def test_clashing_columns_and_empty_tables(spark, odd_docs, items):
    clash = odd_docs.withColumn("n", F.lit("x")).withColumn("score", F.lit(1)).withColumn("item", F.lit(2))
    other = items.withColumn("rank", F.lit("y")).withColumn("doc_id", F.lit("z"))
    assert result(clash, other) == result(odd_docs, items)
    assert result(odd_docs.limit(0), items) == [] and result(odd_docs, items.limit(0)) == []
    assert ranked.search(odd_docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
