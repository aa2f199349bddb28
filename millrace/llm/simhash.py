"""SimHash near-duplicates by deletion-variant signatures.

Two 64-bit fingerprints that differ in at most 4 bits, cut into 3 segments, have a segment that
differs in at most one bit. Such segments are equal once that one bit is deleted. So every
fingerprint is indexed under each of its 64 variants "segment without bit i"; an equality join on
the variants finds all candidates, and their whole distance is verified.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import col, components, fresh, release_memory, text_key, text_of, written

BITS = 64


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of the fewest segments of which one differs by one bit at most."""
    n = distance // 2 + 1
    edges = [BITS * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def shingle_hashes(text: str, size: int, seed: int) -> Iterator[np.ndarray]:
    """Hashes of a text's shingles in blocks, so memory stays bounded; none of a text without words."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return
    line = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    last = ends[min(size, len(words)) - 1 :]
    block = 1 << 16
    for at in range(0, len(last), block):
        spans = zip(starts[at : at + block], last[at : at + block], strict=False)
        yield np.array([digest(line[a : b - 1], seed) for a, b in spans], dtype=np.uint64)


def fingerprint_of(text: str, size: int, seed: int) -> int:
    """Unsigned fingerprint of one text."""
    return fingerprint_of_hashes(shingle_hashes(text, size, seed))


def fingerprint_of_hashes(blocks: Iterable[np.ndarray]) -> int:
    """The same from the blocks of ``shingle_hashes``."""
    ones, total = np.zeros(BITS, dtype=np.int64), 0
    for h in blocks:
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(h)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def fingerprint(text: Column, size: int = 4, seed: int = 42) -> Column:
    """64-bit SimHash of a text, as a (signed) long.

    Words are runs without ASCII blanks, A-Z lower-cased; every shingle of ``size`` words counts
    as often as it occurs, joined by blanks and hashed with XXH64. A text of fewer words is one
    shingle; a text without words, or null, has fingerprint 0.
    """

    @F.pandas_udf("long")
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = np.array([fingerprint_of(t, size, seed) for t in texts], dtype=np.uint64)
            yield pd.Series(values.view(np.int64))
        release_memory()

    return simhash(text)


def _mask(first: int, width: int) -> int:
    value = (1 << width) - 1 << first
    return value - (1 << BITS) if value >= 1 << BITS - 1 else value


def variants(prints: DataFrame, distance: int = 4) -> DataFrame:
    """(fp, bit, variant): for every bit of the fingerprint its segment with that bit deleted."""
    rows = [
        F.struct(
            F.lit(bit).cast("tinyint").alias("bit"),
            F.col("fp").bitwiseAND(F.lit(_mask(first, width) & ~_mask(bit, 1))).alias("variant"),
        )
        for first, width in segments(distance)
        for bit in range(first, first + width)
    ]
    return prints.select("fp", F.inline(F.array(*rows)))


def _shared_variant(x: Column, distance: int) -> Column:
    """Of the variants that two fingerprints with difference ``x`` share, the one to report them by."""
    out = F.lit(-1)
    for first, width in reversed(segments(distance)):
        own = x.bitwiseAND(F.lit(_mask(first, width)))
        n = F.bit_count(own)
        # The bit's number is the number of ones below it.
        out = F.when(n == 0, F.lit(first)).when(n == 1, F.bit_count(own - 1)).otherwise(out)
    return out


def links(prints: DataFrame, distance: int = 4) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints ``fp`` that differ in 1 to ``distance`` bits.

    Each pair comes once, from the first variant that both share, although the join meets it in
    several. Large groups under one variant are split by adaptive execution on both sides.
    """
    # Stored, and joined by sorting: in files the index is a small part of its size in memory, and
    # Spark would broadcast it for that.
    index = written(variants(prints.select("fp").distinct(), distance), "variants")
    a, b = index.alias("a"), index.alias("b").hint("merge")
    x = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    on = (
        (F.col("a.variant") == F.col("b.variant"))
        & (F.col("a.bit") == F.col("b.bit"))
        & (F.col("a.fp") < F.col("b.fp"))
        & (F.bit_count(x) <= distance)
        & (F.col("a.bit") == _shared_variant(x, distance))
    )
    return a.join(b, on).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 4, distance: int = 4
) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``, repeated rows included.

    Rows whose fingerprints differ in ``distance`` bits or fewer are linked; component_id is the
    smallest doc_id that can be reached over links, the row's own included. All texts without
    words have fingerprint 0 and are linked like any others. A null doc_id never is the smallest;
    a component of such rows only has a null component_id. Empty input: no rows.
    """
    return _grouped(docs, doc_id, text, size, distance).select("doc_id", "fp", "component_id")


def _grouped(docs: DataFrame, doc_id: str, text: str, size: int = 4, distance: int = 4) -> DataFrame:
    """The same with the text's digest and the component's root, the smallest fingerprint."""
    own = docs.select(
        col(doc_id).alias("doc_id"), text_key(text_of(text)).alias("text_key"), fingerprint(text_of(text), size).alias("fp")
    )
    prints = written(own, "prints")
    # One row per fingerprint: copies are linked through it and never paired with each other.
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    pairs = links(classes, distance).select(F.col("b").alias("src"), F.col("a").alias("dst"))
    roots = components(pairs).withColumnRenamed("node", "fp")
    classes = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = classes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    owner = classes.join(least, "root").select("fp", "root", "component_id")
    return prints.join(owner, "fp")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each group of near-duplicates: that with the smallest doc_id; same columns.

    Keepers are chosen by group and found again by id and text, so a group without ids keeps a row,
    and another text under a keeper's id doesn't take its place. Where unlike texts of one id are
    the first of their groups, that with the least digest stays; ``nearcopies.drop_near_copies``
    keeps all. Rows equal in id and text are interchangeable.
    """
    found = _grouped(docs, doc_id, text, **options)
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    first = found.groupBy("root").agg(F.min(place).alias("k")).select("k.doc_id", "k.text_key")
    ids = first.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("text_key").alias("text_key"))
    own_id, own_key, rank = fresh(docs, "own_id", "own_key", "rank")
    kept = written(ids.union(first.where("doc_id IS NULL")).toDF(own_id, own_key), "kept")
    left = docs.withColumn(own_key, text_key(text_of(text)))
    on = (left[own_key] == kept[own_key]) & col(doc_id).eqNullSafe(kept[own_id])
    left = left.join(kept, on, "left_semi")
    order = Window.partitionBy(col(doc_id), F.col(own_key)).orderBy(F.lit(1))
    return left.withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1).drop(own_key, rank)
