"""The prefix trie against one built turn by turn."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import turntrie
from tests.conftest import TESTDATA
from tests.llm.brute import sha

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turn_order(row):
    _, turn, role, text = row
    body = f"{len((role or '').encode())}:{role or ''}{text or ''}"
    return (turn is not None, turn or 0), hashlib.md5(body.encode()).digest()


def rebuilt(rows):
    """{conv_id: path of (role, text)}"""
    own = {}
    for row in sorted(rows, key=turn_order):
        own.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    out = {}
    for c, path in own.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 6
        out[c] = (own.get(c - c % 100, [])[:h] if h else []) + path[h:]
    return out


def trie(paths):
    members = {}
    for c, path in paths:
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append((c, len(path)))
    kids, leaves, saved = {}, {}, {}
    for node in members:
        if node:
            kids[node[:-1]] = kids.get(node[:-1], 0) + 1
    for node, own in members.items():
        for d in range(len(node) + 1):
            top = node[:d]
            leaves[top] = leaves.get(top, 0) + (node not in kids)
            saved[top] = saved.get(top, 0) + ((len(own) - 1) * len(node[-1][1]) if node else 0)

    def first(node):
        return min((c for c, _ in members[node] if c is not None), default=None)

    out = []
    for node, own in members.items():
        ends = ",".join(str(c) for c in sorted(c for c, n in own if n == len(node) and c is not None))
        parent = first(node[:-1]) if node else None
        out.append((first(node), len(node), parent, len(own), kids.get(node, 0), leaves[node], saved[node], sha(ends)))
    return sorted(out, key=repr)


def result(df):
    paths = turntrie.rebuilt(turntrie.conversation_paths(df))
    return sorted((tuple(r) for r in turntrie.prefix_trie(paths).select(*COLUMNS).collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)


def talks(seed, n=300, longest=9, words=("a", "bb", "ccc", "日本")):
    make = random.Random(seed)
    rows = []
    for c in make.sample(range(n * 2), n):
        for t in range(make.randint(1, longest)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", make.choice(words)))
    return rows


@pytest.fixture
def odd_talks():
    rows = talks(1) + [(300, None, None, None), (301, 1, "user", ""), (302, 1, "", "user"), (None, 0, "user", "a"), (None, 1, "x", "y")]
    rows += rows[:40]  # repeated turns
    rows += [(k, t, "user", "the same start of many") for k in range(2000, 2400) for t in range(3)]
    rows += [(5000, t, "user", str(t % 7)) for t in range(700)] + [(5001, t, "user", str(t % 7)) for t in range(650)]
    return [*rows, (6001, 0, "user", "long " * 50_000)]


def test_equals_plain_trie(spark, odd_talks):
    assert result(frame(spark, odd_talks)) == trie(rebuilt(odd_talks).items())


def test_many_shards(spark, odd_talks):
    rows = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert result(frame(spark, odd_talks)) == trie(rebuilt(odd_talks).items())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", rows)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("width", [1, 3, 64])
def test_one_shard_by_panels(monkeypatch, width):
    monkeypatch.setattr(turntrie, "PANEL", width)
    make = random.Random(4)
    paths = [(c, [("r", make.choice("ab")) for _ in range(make.randint(0, 11))]) for c in range(200)]
    numbers = {t: k for k, t in enumerate(sorted({t for _, p in paths for t in p}))}
    flat = np.array([numbers[t] for _, p in paths for t in p], dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum([len(p) for _, p in paths])))
    shard = turntrie.Shard(np.arange(200), starts, flat, flat, np.ones(len(flat), dtype=np.int64))
    order = turntrie.sorted_rows(shard)
    assert [paths[k] for k in order] == sorted(paths, key=lambda p: ([numbers[t] for t in p[1]], p[0]))
    found = turntrie.levels(shard, order, edges_open=False)
    got = [
        (int(lv.first[k]), d, int(found[d - 1].first[lv.parent[k]]) if d else None, *(int(x[k]) for x in (lv.n, lv.kids, lv.leaves, lv.saved)))
        for d, lv in enumerate(found)
        for k in range(len(lv.start))
    ]
    assert sorted(got, key=repr) == sorted((r[:-1] for r in trie(paths)), key=repr)


def test_equals_plain_trie_on_conversations(spark):
    df = spark.read.parquet(str(TESTDATA / "conversations.parquet")).select("conv_id", "turn", "role", "text")
    assert result(df) == trie(rebuilt([tuple(r) for r in df.collect()]).items())


def test_one_path_of_a_third_of_all(spark):
    """Equal conversations fill several shards; the ids that end there are joined in order."""
    rows = [(k, t, "user", f"same {t}") for k in range(1, 4000, 2) for t in range(2)]
    rows += [(k, 0, "user", f"own {k}") for k in range(0, 4000, 2)]
    assert result(frame(spark, rows)) == trie(rebuilt(rows).items())


def test_turnless_clashing_and_empty(spark):
    # Conversations of another family without its first one lose their first turns, some all.
    rows = [(c, 0, "user", "hi") for c in range(101, 160)]
    want = trie(rebuilt(rows).items())
    assert result(frame(spark, rows)) == want and any(r[1] == 0 and r[7] != sha("") for r in want)
    clash = frame(spark, rows).withColumn("family", F.lit("x")).withColumn("id", F.lit(1)).withColumn("t", F.lit(2)).withColumn("chars", F.lit(""))
    assert result(clash) == want
    assert result(frame(spark, rows).limit(0)) == []


def test_last_turns(spark):
    df = frame(spark, [(1, 0, "user", "a"), (2, 0, "user", "b")])
    paths = turntrie.conversation_paths(df).select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.chars").alias("chars"))
    got = {r.conv_id: r.turn_id for r in turntrie.prefix_trie(paths).where("depth = 1").collect()}
    assert got == {k: hashlib.md5(f"4:user{t}".encode()).digest() for k, t in ((1, "a"), (2, "b"))}
