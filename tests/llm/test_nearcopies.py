"""Near copies against all pairs of shingle sets."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import nearcopies
from tests.conftest import TESTDATA


def shingles(text, size=5):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def keepers(rows):
    """(doc_id, text) that stay, with all pairs compared."""
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x == y or 5 * len(x & y) >= 4 * len(x | y) > 0:
                root[find(i)] = find(j)
    groups = {}
    for k, row in enumerate(rows):
        groups.setdefault(find(k), []).append(row)
    # Which of several texts under a group's smallest id stays is fixed by digests.
    return [min(((i is None, i or 0) for i, _ in g)) for g in groups.values()]


def near_rows(seed=11):
    make = random.Random(seed)
    line = [f"c{k}" for k in range(12)]
    rows = []
    for k in range(40):
        words = line * (k % 3 == 0) + [f"w{make.randint(0, 9999)}" for _ in range(make.randint(3, 150))]
        for _ in range(make.randint(1, 5)):
            own = list(words)
            for _ in range(make.randint(0, max(1, len(own) // 40))):
                own[make.randrange(len(own))] = f"v{make.randint(0, 9999)}"
            rows.append((len(rows), " ".join(own)))
    return rows


@pytest.mark.parametrize("common_least", [nearcopies.COMMON_LEAST, 1])
def test_equals_all_pairs(spark, monkeypatch, common_least):
    monkeypatch.setattr(nearcopies, "COMMON_LEAST", common_least)
    monkeypatch.setattr(nearcopies, "SAMPLE", 2)
    rows = near_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(r.doc_id for r in nearcopies.drop_near_copies(df).collect())
    want = sorted(i for _, i in keepers(rows))
    assert got == want and len(want) < len(rows)


def test_pipeline_stage_equals_all_pairs(spark):
    docs = corpus_pipeline.quality_rules(spark, spark.read.parquet(str(TESTDATA / "documents.parquet")), str(TESTDATA))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, str(TESTDATA)).collect())
    assert got == sorted(i for _, i in keepers(rows))


def test_odd_rows(spark, odd_docs, odd_rows):
    kept = nearcopies.drop_near_copies(odd_docs)
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    assert kept.columns == ["doc_id", "text"] and got == sorted(keepers(odd_rows))
    assert nearcopies.drop_near_copies(odd_docs.limit(0)).count() == 0


def test_fingerprints_come_first(spark, monkeypatch):
    """Close copies are linked through SimHash, and no rounds over prefixes are needed for them."""
    asked = []
    links, pivots = nearcopies.simhash.links, nearcopies._to_pivots
    monkeypatch.setattr(nearcopies.simhash, "links", lambda *a: asked.append("links") or links(*a))
    monkeypatch.setattr(nearcopies, "_to_pivots", lambda *a: asked.append("pivots") or pivots(*a))
    words = [f"w{k}" for k in range(600)]
    rows = [(k, " ".join([*words[:300], f"v{k}", *words[301:]])) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.doc_id for r in nearcopies.drop_near_copies(df).collect()] == [0]
    assert asked == ["links"]


def test_pivot_rounds_keep_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(nearcopies, "FEW_PAIRS", 0)
    rows = near_rows(seed=5)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(r.doc_id for r in nearcopies.drop_near_copies(df).collect())
    assert got == sorted(i for _, i in keepers(rows))


def edited(copies, seed=3):
    """One text with up to 20 of its 150 words changed in each row: near the others, at the limit, or behind it."""
    make = random.Random(seed)
    words, rows = [f"w{k}" for k in range(150)], []
    for k in range(copies):
        own = list(words)
        for at in make.sample(range(150), make.randint(0, 20)):
            own[at] = f"v{make.randint(0, 9999)}"
        rows.append((k, " ".join(own)))
    return rows


def test_large_group_makes_few_pairs(spark, monkeypatch):
    """Of a group of edited copies only those may be paired whose sets still can be near."""
    monkeypatch.setattr(nearcopies, "SAMPLE", 1)
    stored, asked = {}, nearcopies.Scratch.store

    def store(self, df, purpose):
        out = asked(self, df, purpose)
        stored.setdefault(purpose, []).append(out.count())
        return out

    monkeypatch.setattr(nearcopies.Scratch, "store", store)
    rows = edited(240)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(r.doc_id for r in nearcopies.drop_near_copies(df).collect())
    want = sorted(i for _, i in keepers(rows))
    assert got == want and 10 < len(want) < 230
    assert sum(stored["across"]) < 10 * len(rows) and sum(stored["pairs"]) < 10 * len(rows)


def test_sketches_never_differ_in_more_bits_than_sets(spark):
    make = random.Random(2)
    for _ in range(200):
        a, b = (np.unique(np.array([make.getrandbits(64) for _ in range(make.randint(0, 90))], dtype=np.uint64)) for _ in "ab")
        b = np.union1d(a[::2], b)
        bits = np.bitwise_count((nearcopies.sketch(a) ^ nearcopies.sketch(b)).view(np.uint64)).sum()
        assert bits <= len(np.setxor1d(a, b)) and len(nearcopies.sketch(a)) * 64 == nearcopies.SKETCH


def test_sketches_tell_long_sets_apart(spark):
    """Sets of some thousand members that share half of them need no look at the members; no near pair is lost
    where one sketch has twice the bits of the other."""
    make = random.Random(4)
    rows = []
    for n, m, shared in ((3000, 3000, 2000), (20000, 20000, 13000), (1000, 1100, 990), (2040, 2060, 1850), (4000, 4900, 3960), (90, 80, 80)):
        members = np.unique(np.array([make.getrandbits(64) for _ in range(n + m - shared)], dtype=np.uint64))
        make.shuffle(members)
        a, b = np.sort(members[:n]), np.sort(members[n - shared :])
        rows.append((n, m, shared, nearcopies.sketch(a).tolist(), nearcopies.sketch(b).tolist()))
    df = spark.createDataFrame(rows, "n int, m int, shared int, a array<long>, b array<long>")
    for x, y in (("a", "b"), ("b", "a")):
        got = df.withColumn("bits", nearcopies.differing(F.col(x), F.col(y)))
        for r in got.collect():
            assert r.bits <= r.n + r.m - 2 * r.shared
            assert (9 * r.bits <= r.n + r.m) == (9 * r.shared >= 4 * (r.n + r.m))


def test_long_texts_equal_all_pairs(spark):
    """Copies with more or fewer edits, of lengths around those at which sketches double."""
    make = random.Random(9)
    rows = []
    for length in (900, 1020, 1980, 2100):
        words = [f"w{make.randint(0, 99999)}" for _ in range(length)]
        for k in range(6):
            own = list(words) + [f"t{make.randint(0, 99999)}" for _ in range(make.randint(0, length // 8))]
            for at in make.sample(range(length), length * make.randint(0, 5) // 100):
                own[at] = f"v{make.randint(0, 99999)}"
            rows.append((len(rows), " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(r.doc_id for r in nearcopies.drop_near_copies(df).collect())
    want = sorted(i for _, i in keepers(rows))
    assert got == want and 4 < len(want) < 24


def test_pairs_left_counts_kinds(spark):
    """Groups that stand late under a key can't be near and aren't counted; others are, each pair once."""
    rows = [(k, 100, k, 1, 100) for k in range(5)] + [(k, 100, k, 1, 82) for k in range(5, 50)] + [(9, 100, 9, 2, 100)]
    members = spark.createDataFrame(rows, "node long, n int, root long, key long, left int")
    assert nearcopies._pairs_left(members) == 10
    assert nearcopies._pairs_left(members.where(F.col("key") == 3)) == 0
