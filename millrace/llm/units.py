"""Substring dedup by hashing units: lines, cut at sentence ends."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import col, cut, fresh, text_of, written

# A unit ends with its line or, within a line, with a sentence.
UNIT = re.compile(rb"[^\n]*?(?:\n|[.!?] +(?=\S)|\Z)")


def units_of(text: str, least_words: int) -> list[tuple[bytes, int, int]]:
    """(digest, start, end) in bytes of every unit with at least ``least_words`` words.

    Digests are of the normalised unit: A-Z lower-cased, runs of ASCII blanks one blank.
    """
    raw = text.encode("utf-8", "surrogatepass")
    out = []
    for m in UNIT.finditer(raw):
        words = m[0].lower().split()
        if len(words) >= least_words:
            digest = hashlib.blake2b(b" ".join(words), digest_size=16).digest()
            out.append((digest, m.start(), m.end()))
    return out


def hashed_units(docs: DataFrame, doc_id: str, text: str, least_words: int) -> DataFrame:
    """(doc_id, text_hash, digest, start, end); a text's hash tells rows of one id apart."""
    kind = docs.select(col(doc_id)).schema[0].dataType.simpleString()
    # As a string, since pandas would hold integers with nulls as floats.
    own = docs.select(col(doc_id).cast("string").alias("doc_id"), text_of(text).alias("text"))
    own = own.withColumn("text_hash", F.xxhash64("text"))

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["doc_id", "text_hash", "digest", "start", "end"]
        for batch in batches:
            rows: list[tuple] = []
            for i, h, body in zip(batch["doc_id"], batch["text_hash"], batch["text"], strict=True):
                rows += [(i, h, *unit) for unit in units_of(body, least_words)]
                if len(rows) > 100_000:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            yield pd.DataFrame(rows, columns=columns)

    found = own.mapInPandas(emit, "doc_id string, text_hash long, digest binary, start long, end long")
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))


def repeated_units(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_words: int = 8) -> DataFrame:
    """Units to remove: all but the first occurrence of each digest in order of (doc_id, start).

    Rows of one id and different texts are ordered by text hash; rows equal in id and text are one
    document. A null id ranks first. Digests are counted and ranked with map-side combining, so a
    line that a third of the documents has is one row per task; the join that marks occurrences is
    split by adaptive execution where a digest is hot.
    """
    units = written(hashed_units(docs, doc_id, text, least_words).distinct(), "units")
    place = F.struct("doc_id", "text_hash", "start")
    first = units.groupBy("digest").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    # Stored, so that the join is between two plain shuffles, and hot digests can be split.
    repeated = written(first.where("n > 1").select("digest", "first"), "repeated")
    return units.join(repeated, "digest").where(place != F.col("first")).drop("first")


def dedup_units(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_words: int = 8) -> DataFrame:
    """``docs`` with ``kept_text`` and ``removed``: array of (start, end), bytes of the original text.

    Units shorter than ``least_words`` words stay; a text without repeated units is unchanged
    (null: empty). No rows: no rows.
    """
    gone = repeated_units(docs, doc_id, text, least_words)
    spans = gone.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    key, own, removed, kept = fresh(docs, "u_key", "u_hash", "removed", "kept_text")
    spans = spans.select(F.col("doc_id").alias(key), F.col("text_hash").alias(own), F.col("spans").alias(removed))
    left = docs.withColumn(own, F.xxhash64(text_of(text)))
    on = (left[own] == spans[own]) & col(doc_id).eqNullSafe(spans[key])
    joined = left.join(spans, on, "left").drop(spans[own]).drop(own, key)
    none = F.array().cast("array<struct<start: long, end: long>>")
    joined = joined.withColumn(removed, F.coalesce(F.col(removed), none))
    return joined.withColumn(kept, F.when(F.size(removed) == 0, text_of(text)).otherwise(cut(text_of(text), F.col(removed))))
