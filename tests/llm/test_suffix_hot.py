"""Regions that very many documents have, with another text around them in each."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from millrace.llm import suffix
from millrace.llm.common import text_key
from tests.llm import brute


def test_hot_region_is_split(spark, monkeypatch):
    make = random.Random(2)

    def noise(n):
        return "".join(make.choice("abcdefghij ") for _ in range(n))

    short, long = noise(300), noise(430)
    texts = [noise(500) + (short if k % 2 else long) + noise(500) for k in range(200)]
    texts += [texts[1][100:1100], texts[2][300:], "x" + texts[4][:1200]]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    keyed = docs.select(text_key(F.col("text")).alias("text_key"), "text")
    heaviest = F.max("bytes").alias("most")
    monkeypatch.setattr(suffix, "HOT_BYTES", 8000)
    _, distinct = suffix.dealt_contexts(keyed, 400)
    assert distinct.groupBy("key").agg(F.sum("size").alias("bytes")).agg(heaviest).first().most <= 8000
    got = {r.doc_id: [tuple(s) for s in r.repeats] for r in suffix.mark_repeats(docs).collect()}
    assert got == dict(zip(range(len(texts)), brute.repeats(texts, 400), strict=True))
    monkeypatch.setattr(suffix, "HOT_BYTES", 1 << 40)
    _, whole = suffix.dealt_contexts(keyed, 400)
    assert whole.groupBy("key").agg(F.sum("size").alias("bytes")).agg(heaviest).first().most > 8000
