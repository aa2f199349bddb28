"""Source mixing against a plain version."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm import mixing
from tests.conftest import TESTDATA
from tests.llm.brute import WORD
from tests.llm.conftest import LONG


def targets(sizes, share=1.5, most=2):
    """{source: target} by sharing out again until no target is above its bound."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: float((3, 1, 2)[k % 3]) for k, s in enumerate(order)}
    full, left = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in full]
        level = left / sum(weight[s] for s in open_) if open_ else 0.0
        over = [s for s in open_ if most * sizes[s] < level * weight[s]]
        if not over:
            return full | {s: level * weight[s] for s in open_}
        for s in over:
            full[s] = float(most * sizes[s])
            left -= full[s]


def key(doc_id, text, size):
    digest = hashlib.md5(f"{'' if doc_id is None else doc_id}|13|{hashlib.md5((text or '').encode()).hexdigest()}".encode()).hexdigest()
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    weight = size / (size + 50) * (size / (size + 5 * symbols)) if size else 0
    uniform = (int(digest[:13], 16) + 0.5) / (1 << 52)
    return (-math.log(uniform) / weight if weight else math.inf, int(digest[13:28], 16))


def mix(rows):
    """Bag of (doc_id, source, size, source_size, target, taken) of (doc_id, text, source) rows."""
    sizes, groups = Counter(), defaultdict(list)
    for doc_id, text, source in rows:
        size = len(WORD.findall(text or ""))
        sizes[source] += size
        groups[source].append((key(doc_id, text, size), doc_id, size))
    goal, out = targets(sizes), []
    for source, own in groups.items():
        budget = math.floor(goal[source] + 0.5)
        epochs, rest = divmod(budget, sizes[source]) if sizes[source] else (0, 0)
        for _, doc_id, size in sorted(own, key=lambda r: r[0]):
            part = max(0, min(size, rest))
            rest -= part
            out.append((doc_id, source, size, sizes[source], goal[source], epochs * size + part))
    return out


def bag(rows):
    return Counter((*r[:4], f"{r[4]:.9g}", r[5]) for r in rows)


def result(df, **options):
    out = mixing.mix_sources(df, **options)
    return [tuple(r) for r in out.select("doc_id", "source", "size", "source_size", "target", "taken").collect()]


@pytest.fixture
def sourced(spark, odd_rows):
    names = ["a", "Z", "é", None, "", "b", "日本"]
    return [(i, t, names[k % len(names)]) for k, (i, t) in enumerate(odd_rows)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)


@pytest.mark.parametrize("at_once", [mixing.SORTED_AT_ONCE, 1])
def test_equals_plain_version(spark, sourced, monkeypatch, at_once):
    monkeypatch.setattr(mixing, "SORTED_AT_ONCE", at_once)
    assert bag(result(frame(spark, sourced))) == bag(mix(sourced))


def test_equals_plain_version_on_documents(spark):
    docs = spark.read.parquet(str(TESTDATA / "documents.parquet"))
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    assert bag(result(docs)) == bag(mix(rows))


def test_equal_rows_at_the_cut(spark):
    """A third of all rows are one row, and its source's budget ends inside that group."""
    rows = [(None, "same words again " * 5, "hot")] * 500 + [(k, f"w{k} " * (k % 40), f"s{k % 5}") for k in range(1000)]
    rows += [(k, "x " * 3000, "wide") for k in range(3)]
    df = frame(spark, rows).repartition(7)
    got = result(df)
    assert bag(got) == bag(mix(rows))
    hot = [r[5] for r in got if r[1] == "hot"]
    assert 0 < sum(hot) < 15 * 500 * 2 and len(set(hot)) >= 2


def test_words_meet_targets_and_bounds(spark, sourced):
    got = result(frame(spark, sourced))
    taken, goal = Counter(), {}
    for _, source, size, own, target, n in got:
        assert 0 <= n <= 2 * size and target <= 2 * own
        taken[source] += n
        goal[source] = target
    assert all(abs(taken[s] - goal[s]) <= 0.5 for s in goal)
    assert abs(sum(goal.values()) - 1.5 * sum(r[2] for r in got)) < 1e-6


def test_reruns_agree_over_other_partitions(spark, sourced):
    df = spark.createDataFrame(sourced, "doc_id long, text string, source string")
    assert bag(result(df.repartition(1))) == bag(result(df.repartition(9)))


def test_quality_draws_better_documents(spark):
    """The same sizes, half of them full of symbols: their share of the fractional epoch is less."""
    rows = [(k, ("plain word " * 30) if k % 2 else ("# $ " * 30), "only") for k in range(600)]
    rows += [(1000 + k, "other words here " * 20, "rest") for k in range(600)]
    docs = frame(spark, rows)
    got = [r for r in result(docs, share=0.2) if r[1] == "only"]
    clean = sum(r[5] for r in got if r[0] % 2)
    assert clean > 3 * (sum(r[5] for r in got) - clean) > 0


def test_own_weights_and_carried_columns(spark):
    rows = [(k, "a b c d", "s", k, "x", "y") for k in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, place long, size string, carried string")
    out = mixing.mix_sources(df, weight=F.when(F.col("place") < 10, F.lit(1e9)), share=0.2, carry=["place", "size", "carried"])
    rows = out.collect()
    assert sorted(r.doc_id for r in rows if r.taken) == list(range(10))
    assert {r.carried.asDict()["size"] for r in rows} == {"x"} and out.columns[-1] == "carried"


def test_texts_of_the_mix(spark, sourced):
    df = frame(spark, sourced)
    texts = mixing.mixed_texts(df).collect()
    words = Counter()
    for r in texts:
        words[r.source] += len(WORD.findall(r.text))
    want = Counter()
    for r in result(df):
        want[r[1]] += r[5]
    assert +words == +want
    assert any(r.text == LONG for r in texts)


def test_empty_and_wordless(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert result(none) == [] and mixing.mixed_texts(none).count() == 0
    blank = [(1, None, "a"), (2, "  ", None), (3, "", "b")]
    assert sorted(result(frame(spark, blank)), key=repr) == sorted(mix(blank), key=repr)


def test_native_plan(spark, plan_of):
    docs = spark.read.parquet(str(TESTDATA / "documents.parquet"))
    plan = plan_of(mixing.mix_sources(docs))
    for operator in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"):
        assert operator not in plan
