"""Suffix-array dedup: bytes covered by long strings that start at more than one place.

Two equal strings of ``length`` bytes have their anchor, the window's k-gram with the least hash,
at the same place. Around it, all strings that begin in one band before the anchor have a region
in common. So each text falls into contexts: the starts with one anchor and band, together with
the bytes that their strings reach, known by the hash of the region. Only contexts whose region
is found elsewhere can hold a repeat. They are dealt by it to shards, equal contexts once, and
each shard's suffixes are sorted by external induced sorting (see ``induced``); where suffixes
next to each other share ``length`` bytes or more, their starts are repeats. Every string is in
exactly one context, and all its copies are in the same shard: the result is that of one suffix
array over the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import col, cut, fresh, release_memory, text_key, text_of, written
from millrace.llm.induced import SEPARATOR, Scratch, Shard, repeated_starts

GRAM = 32  # bytes of an anchor's k-gram, a power of two
BANDS = 2
PIECE = 1 << 18  # bytes that are hashed at once
PLACE_BITS = 20  # of a packed order value; above a piece's size, with a string's length
SHARD_BYTES = 3 << 20
HOT_BYTES = 3 << 20  # of distinct contexts with one region; more are split into narrower bands
BASE = 0x9E3779B97F4A7C15


def _gram_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position, by doubling the span."""
    h = raw.astype(np.uint64) + np.uint64(1)
    base, span = BASE, 1
    while span < GRAM:
        h = h[:-span] * np.uint64(base) + h[span:]
        base, span = base * base % (1 << 64), 2 * span
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values, from minima to and from block borders."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    to = np.minimum.accumulate(grid, axis=1).ravel()
    since = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(since[: n - width + 1], to[width - 1 : n])


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse, modulo 2**64."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        factors = np.full(n, base, dtype=np.uint64)
        factors[0] = 1
        out.append(np.cumprod(factors, dtype=np.uint64))
    return out[0], out[1]


def contexts_of(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text number, region hash, first start, size, bytes from it to the anchor) of the contexts of texts of ``length`` bytes or
    more. Short texts are hashed together, long ones in overlapping pieces, so memory is bounded."""
    powers = _powers(PIECE + 2 * length)
    group: list[tuple[int, int, bytes]] = []
    held = 0
    for number, text in enumerate(texts):
        for offset in range(0, len(text) - length + 1, PIECE):
            part = text[offset : offset + PIECE + length - 1]
            if held + len(part) > PIECE + length and group:
                yield _contexts(group, length, powers)
                group, held = [], 0
            group.append((number, offset, part))
            held += len(part)
    if group:
        yield _contexts(group, length, powers)


def _contexts(group: list[tuple[int, int, bytes]], length: int, powers: tuple[np.ndarray, np.ndarray]):
    raw = np.frombuffer(b"".join([part for _, _, part in group]), dtype=np.uint8)
    sizes = np.array([len(part) for _, _, part in group])
    begins = np.cumsum(sizes) - sizes
    h = _gram_hashes(raw)
    packed = (h >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(h), dtype=np.uint64)
    least = _sliding_min(packed, length - GRAM + 1)
    anchor = (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    # Starts whose string stays in its text.
    inside = np.zeros(len(raw) + 1, dtype=np.int32)
    inside[begins] += 1
    np.add.at(inside, begins + sizes - length + 1, -1)
    start = np.flatnonzero(np.cumsum(inside)[: len(anchor)] > 0)
    anchor = anchor[start]
    width = -(-(length - GRAM + 1) // BANDS)
    band = (anchor - start) // width
    new = np.ones(len(start), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (band[1:] != band[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(start)))
    start, anchor, band = start[first], anchor[first], band[first]
    # All strings of a band reach from its last possible start to the end of its first one.
    region = anchor - band * width
    sums = np.concatenate(([np.uint64(0)], np.cumsum((raw + np.uint64(1)) * powers[0][: len(raw)], dtype=np.uint64)))
    key = (sums[region + length - width + 1] - sums[region]) * powers[1][region]
    key = (key ^ (key >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + band.astype(np.uint64)
    own = np.searchsorted(begins, start, side="right") - 1
    number = np.array([n for n, _, _ in group])[own]
    offset = np.array([o for _, o, _ in group])[own]
    return number, key.view(np.int64), start - begins[own] + offset, count + length - 1, anchor - start


def find_contexts(texts: DataFrame, length: int) -> DataFrame:
    """(text_key, key, start, size, lead): hash, first start, reach and way to the anchor of each text's contexts."""

    def contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = batch["text_key"].to_numpy()
            raw = [t.encode("utf-8", "surrogatepass") for t in batch["text"]]
            for number, key, start, size, lead in contexts_of(raw, length):
                yield pd.DataFrame(
                    {"text_key": keys[number], "key": key, "start": start, "size": size, "lead": lead}
                )
        release_memory()

    return texts.mapInPandas(contexts, "text_key binary, key long, start long, size int, lead int")


def _sorted_shards(length: int):
    """Repeats in the contexts of a partition, which is one shard."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with Scratch() as scratch:
            ids, sizes, copies = [], [], []
            with open(scratch.path(), "w+b") as file:
                for batch in batches:
                    ids += batch["context"].tolist()
                    copies.append(batch["copies"].to_numpy())
                    sizes.append(np.array([len(b) for b in batch["body"]], dtype=np.int64))
                    file.write(b"".join([b + bytes([SEPARATOR]) for b in batch["body"]]))
                if not ids:
                    return
                file.flush()
                shard = Shard(np.memmap(file.name, dtype=np.uint8, mode="r"), scratch, length)
            sizes, copies = np.concatenate(sizes), np.concatenate(copies)
            begins = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
            # Strings start only where they end before their context does.
            eligible = scratch.array(shard.n, bool)
            edge = np.zeros(shard.n + 1, dtype=np.int8)
            edge[begins] += 1
            edge[begins + sizes - length + 1] -= 1
            eligible[:] = np.cumsum(edge[:-1], dtype=np.int8) > 0
            del edge

            def weight(at: np.ndarray) -> np.ndarray:
                return copies[np.searchsorted(begins, at, side="right") - 1]

            flags = repeated_starts(shard, eligible, weight)
            change = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
            first, stop = change[::2], change[1::2]
            owner = np.searchsorted(begins, first, side="right") - 1
            # A run of starts covers the bytes up to its last string's end.
            rows = pd.DataFrame(
                {
                    "context": [ids[k] for k in owner],
                    "from": first - begins[owner],
                    "to": stop - begins[owner] + length - 1,
                }
            )
            for k in range(0, len(rows), 100_000):
                yield rows[k : k + 100_000]
            del shard, eligible, flags, change, first, stop, owner
        release_memory()

    return work


def _with_bodies(texts: DataFrame, places: DataFrame, columns: list[str]) -> DataFrame:
    """``places`` with the bytes that they have in their texts, from one pass over the texts."""
    wanted = places.groupBy("text_key").agg(F.collect_list(F.struct("start", "size", *columns)).alias("all"))
    raw = F.col("text").cast("binary").alias("raw")
    rows = texts.join(wanted, "text_key").select("text_key", raw, F.explode("all").alias("p"))
    body = F.substring("raw", F.col("p.start").cast("int") + 1, F.col("p.size"))
    return rows.select("text_key", "p.start", "p.size", *[f"p.{c}" for c in columns], body.alias("body"))


def _shared(places: DataFrame) -> DataFrame:
    """``places`` whose key another place has, too."""
    shared = places.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    # Stored, so that the join is between two plain shuffles, and hot regions can be split.
    return places.join(written(shared, "shared"), "key")


def _distinct(places: DataFrame) -> DataFrame:
    """Of equal contexts one, which is sorted and stands for all."""
    one = F.struct("text_key", "start", "size", "key")
    distinct = places.groupBy("context").agg(F.count("*").alias("copies"), F.min(one).alias("one"))
    return written(distinct.select("context", "copies", "one.*"), "distinct")


def _narrower(texts: DataFrame, places: DataFrame, width: int, length: int) -> DataFrame:
    """``places`` split into bands of ``width`` starts, each known by the longer region that its
    strings have in common. Bands count from the anchor, so equal strings stay together."""
    rows = _with_bodies(texts, places, ["key", "lead"])
    # Starts are ``lead`` to ``last`` bytes before the anchor.
    last = F.col("lead") - F.col("size") + length
    bands = F.sequence(F.floor(last / width).cast("int"), F.floor(F.col("lead") / width).cast("int"))
    rows = rows.select("*", last.alias("last"), F.explode(bands).alias("band"))
    far = F.least(F.col("lead"), (F.col("band") + 1) * width - 1)
    near = F.greatest(F.col("last"), F.col("band") * width)
    skipped, size = F.col("lead") - far, far - near + length
    region = F.substring("body", F.col("lead") - F.col("band") * width + 1, F.lit(length - width + 1))
    return rows.select(
        "text_key",
        F.xxhash64("key", "band", region).alias("key"),
        (F.col("start") + skipped).alias("start"),
        size.cast("int").alias("size"),
        far.cast("int").alias("lead"),
        F.unhex(F.md5(F.substring("body", skipped + 1, size))).alias("context"),
    )


def dealt_contexts(texts: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Places (text_key, start, size, key, lead, context) that may hold repeats, and the distinct
    contexts among them (context, copies, text_key, start, size, key).

    A region with more than HOT_BYTES of distinct contexts, such as a passage with another text
    around it in every document, is split into narrower bands, down to single strings; of these,
    equal ones are one context. So no key has more bytes than that.
    """
    found = written(find_contexts(texts, length), "contexts")
    places = _with_bodies(texts, _shared(found), ["key", "lead"])
    places = written(places.withColumn("context", F.unhex(F.md5("body"))).drop("body"), "places")
    distinct = _distinct(places)
    width = -(-(length - GRAM + 1) // BANDS)
    while width > 1:
        width = -(-width // 8)
        hot = distinct.groupBy("key").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > HOT_BYTES)
        hot = written(hot.select("key"), "hot")
        if hot.isEmpty():
            break
        split = written(_narrower(texts, places.join(hot, "key", "left_semi"), width, length), "split")
        places = written(places.join(hot, "key", "left_anti").unionByName(_shared(split)), "places")
        distinct = _distinct(places)
    return places, distinct


def repeated_spans(texts: DataFrame, length: int = 400) -> DataFrame:
    """(text_key, spans): byte spans of each distinct text that are covered by repeated strings.

    ``texts`` has one row (text_key, text) per distinct text. Spans are disjoint, in order, and do
    not touch. Texts without a repeat have no row.
    """
    spark = texts.sparkSession
    places, distinct = dealt_contexts(texts, length)
    volume = distinct.agg(F.sum("size")).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(volume) // SHARD_BYTES))
    dealt = _with_bodies(texts, distinct, ["context", "copies", "key"]).repartition(shards, "key")
    runs = dealt.select("context", "copies", "body").mapInPandas(
        _sorted_shards(length), "context binary, from long, to long"
    )
    runs = written(runs, "runs")
    spans = places.select("text_key", "start", "context").join(runs, "context")
    begin, end = F.col("start") + F.col("from"), F.col("start") + F.col("to")
    spans = spans.groupBy("text_key").agg(
        F.array_sort(F.collect_list(F.struct(begin.alias("start"), end.alias("end")))).alias("s")
    )
    # Later spans end later. Those that overlap or touch become one.
    s = F.col("s")
    begins = F.filter(s, lambda x, i: F.coalesce(x["start"] > F.get(s, i - 1)["end"], F.lit(True)))
    ends = F.filter(s, lambda x, i: F.coalesce(F.get(s, i + 1)["start"] > x["end"], F.lit(True)))
    merged = F.zip_with(begins, ends, lambda a, b: F.struct(a["start"].alias("start"), b["end"].alias("end")))
    return spans.select("text_key", merged.alias("spans"))


def mark_repeats(docs: DataFrame, text: str = "text", length: int = 400) -> DataFrame:
    """``docs`` with ``repeats``: byte spans (start, end) of each whole text, in order.

    A byte is in a span if a string of ``length`` bytes that covers it also starts anywhere else:
    in another row, or at another place of this one; overlapping strings count, strings never
    cross rows, and are judged on the input. Rows with equal texts are copies of each other, so
    such a text of ``length`` bytes or more is one span. Null counts as empty; texts of fewer than
    ``length`` bytes have none. Ids are not used: repeated rows and null ids make no difference.
    """
    (key,) = fresh(docs, "text_key")
    own = docs.select(text_key(text_of(text)).alias("text_key"), text_of(text).alias("text"))
    # One row per distinct text; a task sends one, however many copies it has read.
    texts = own.where(F.octet_length("text") >= length).groupBy("text_key")
    texts = written(texts.agg(F.first("text").alias("text"), F.count("*").alias("copies")), "texts")
    copies = texts.select("text_key", "copies", F.octet_length("text").alias("size"))
    spans = repeated_spans(texts.select("text_key", "text"), length)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("size").cast("long").alias("end")))
    marks = copies.join(spans, "text_key", "left").select(
        F.col("text_key").alias(key), F.when(F.col("copies") > 1, whole).otherwise(F.col("spans")).alias("spans")
    )
    marks = written(marks.where("spans IS NOT NULL"), "marks")
    (name,) = fresh(docs, "repeats")
    none = F.array().cast("array<struct<start: long, end: long>>")
    joined = docs.withColumn(key, text_key(text_of(text))).join(marks, key, "left")
    return joined.withColumn(name, F.coalesce("spans", none)).drop(key, "spans")


def cut_repeats(docs: DataFrame, text: str = "text", length: int = 400) -> DataFrame:
    """``docs`` with repeated bytes cut from the texts; same columns and rows.

    Parts of a character left by a cut go, too. Texts without repeats stay as they are, null too.
    """
    (name,) = fresh(docs, "repeats")
    marked = mark_repeats(docs, text, length)
    body = F.when(F.size(name) == 0, col(text)).otherwise(cut(text_of(text), F.col(name)))
    return marked.withColumn(text, body).drop(name)
