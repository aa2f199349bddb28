from __future__ import annotations

import random

import pytest

from tests.conftest import TESTDATA

LONG = "the cat of and was on a mat. " * 9000


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, repeated rows, repeated ids, unlike scripts, odd blanks."""
    make = random.Random(5)
    words = "the of and alpha beta gamma delta License cc by CC BY Ünïcode 日本 x1 #tag | **".split()
    texts = [None, "", " \t\n ", "one", "one two three", LONG, "a" * 5000, "İstanbul ſoft \u212aelvin\x1c\x85\xa0 end"]
    texts += [" ".join(make.choice(words) for _ in range(make.randint(1, 120))) for _ in range(25)]
    texts += ["same line here\n" * 12, "Licensed under CC BY-NC 4.0.\nAll rights\nreserved. all  RIGHTS reserved"]
    body = " ".join(f"w{make.randint(0, 5000)}" for _ in range(300))
    texts += [body, body + " tail", body.replace("w1", "v1", 1), "head " + body, body]
    out = [(k * 7 % 101, t) for k, t in enumerate(texts)]
    return [*out, out[9], (None, "id is null and the text is not"), (None, None), (out[10][0], "the same id again")]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, "doc_id long, text string").repartition(3)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(str(TESTDATA / "documents.parquet")).select("doc_id", "text")


def same_rows(got, want):
    """Equal as bags of rows; floats to nine digits."""

    def key(row):
        return repr([f"{v:.9g}" if isinstance(v, float) else v for v in row])

    assert sorted(map(key, got)) == sorted(map(key, want))
