"""Ranked lexical search by grouping documents under their matched-term masks.

The terms of a block of items are numbered, and one pass over all texts keeps, for each document,
its length and how often it has each of these terms. A second pass scores. For each item, a
document's matched terms are a row of bits; equal rows are one group, whose maximum score follows
from its mask, its members' highest counts and their least length. Groups are evaluated by
descending maximum, and the rest is left out once that is below the item's tenth best score so far.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import FOLD, col, release_memory, text_of, written

TOP = 10
# A block of items has at most so many different terms (or is one item), and a worker looks at
# so many cells of documents x terms at once.
BLOCK_TERMS = 8192
BLOCK_ITEMS = 2000
CELLS = 1 << 22

_PIECE = 1 << 20


def term_counts(text: str) -> tuple[Counter, int]:
    """Occurrences of each term, and of all; a long text is taken in pieces."""
    raw = text.encode("utf-8", "surrogatepass").translate(FOLD)
    if len(raw) <= _PIECE:
        counts = Counter(raw.split())
        return counts, counts.total()
    counts, at = Counter(), 0
    while at < len(raw):
        end = raw.find(b" ", at + _PIECE)
        end = len(raw) if end < 0 else end
        counts.update(raw[at:end].split())
        at = end
    return counts, counts.total()


@dataclass
class Block:
    """Some items: their ids, and the numbers and repeats of each one's different terms."""

    ids: list
    terms: dict[bytes, int]
    items: list[tuple[np.ndarray, np.ndarray]]


def blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[Block]:
    """Items in blocks of bounded size, streamed partition by partition."""
    block = Block([], {}, [])
    for name, body in benchmark.select(col(item), text_of(text)).toLocalIterator():
        counts, _ = term_counts(body)
        new = sum(t not in block.terms for t in counts)
        if block.ids and (len(block.terms) + new > BLOCK_TERMS or len(block.ids) >= BLOCK_ITEMS):
            yield block
            block = Block([], {}, [])
        numbers = [block.terms.setdefault(t, len(block.terms)) for t in counts]
        block.ids.append(name)
        block.items.append((np.array(numbers, dtype=np.int64), np.array(list(counts.values()), dtype=np.int64)))
    if block.ids:
        yield block


POSTINGS = "doc_id long, n long, terms array<int>, counts array<int>"


def postings(docs: DataFrame, doc_id: str, text: str, terms: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts): the terms in all of every text, and its occurrences of ``terms``."""
    known = docs.sparkSession.sparkContext.broadcast(terms)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value
        for batch in batches:
            sizes, starts, found, counted = [], [0], [], []
            for text in batch.column(1):
                counts, n = term_counts(text.as_py())
                own = counts.keys() & number.keys()
                sizes.append(n)
                found.extend(map(number.__getitem__, own))
                counted.extend(map(counts.__getitem__, own))
                starts.append(len(found))
            offsets = pa.array(starts, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v, pa.int32())) for v in (found, counted)]
            columns = [batch.column(0), pa.array(sizes, pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "counts"])
        release_memory()

    return docs.select(col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("t")).mapInArrow(work, POSTINGS)


@dataclass
class Best:
    """An item's best documents so far, in order: score descending, then id, null last."""

    score: np.ndarray
    none: np.ndarray
    doc: np.ndarray

    @classmethod
    def nothing(cls) -> Best:
        return cls(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))

    def add(self, score: np.ndarray, none: np.ndarray, doc: np.ndarray, top: int) -> None:
        score, none, doc = (np.concatenate(p) for p in ((self.score, score), (self.none, none), (self.doc, doc)))
        order = np.lexsort((doc, none, -score))[:top]
        self.score, self.none, self.doc = score[order], none[order], doc[order]

    def bar(self, top: int) -> int:
        """Documents with less than this score can't enter."""
        return int(self.score[-1]) if len(self.score) == top else 1


def parts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds for each of its weight; rises with ``tf`` and falls with ``m``."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m[:, None])


def by_mask(present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows by their bits, and where each run of equal ones starts in it."""
    bits = np.packbits(present, axis=1)
    words = np.zeros((len(bits), -(-bits.shape[1] // 8) * 8), dtype=np.uint8)
    words[:, : bits.shape[1]] = bits
    masks = words.view(np.uint64)
    order = np.lexsort(masks.T) if masks.shape[1] > 1 else np.argsort(masks[:, 0], kind="stable")
    masks = masks[order]
    change = np.ones(len(masks), dtype=bool)
    change[1:] = (masks[1:] != masks[:-1]).any(axis=1)
    return order, np.flatnonzero(change)


def search_batch(tf: np.ndarray, m: np.ndarray, none: np.ndarray, doc: np.ndarray, weight: np.ndarray, best: Best, top: int) -> None:
    """Bring ``best`` of one item up to date with a batch. ``tf``: documents x the item's terms."""
    some = np.flatnonzero((tf > 0).any(axis=1))
    if not len(some):
        return
    tf, m = tf[some].astype(np.int64), m[some]
    present = tf > 0
    # A first bound from the batch's highest counts and least length spares most documents the grouping.
    loose = parts(tf.max(axis=0)[None, :], m.min(keepdims=True))[0] * weight
    hopeful = np.flatnonzero(present @ loose >= best.bar(top))
    tf, m, present, some = tf[hopeful], m[hopeful], present[hopeful], some[hopeful]
    if not len(some):
        return
    order, starts = by_mask(present)
    ends = np.append(starts[1:], len(order))
    most = np.maximum.reduceat(tf[order], starts, axis=0)
    least = np.minimum.reduceat(m[order], starts)
    bound = parts(most, least) @ weight
    ranked = np.argsort(-bound, kind="stable")
    at, step = 0, 4 * top
    while at < len(ranked) and bound[ranked[at]] >= best.bar(top):
        groups = ranked[at : at + step]
        rows = order[np.concatenate([np.arange(starts[g], ends[g]) for g in groups])]
        score = parts(tf[rows], m[rows]) @ weight
        good = np.flatnonzero(score >= best.bar(top))
        rows = some[rows[good]]
        best.add(score[good], none[rows], doc[rows], top)
        at, step = at + step, 2 * step


def candidates(rows: DataFrame, block: Block, weights: np.ndarray, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(item, doc_id, score): each task's best documents for each item of the block, by number."""
    own = [(numbers, repeats * weights[numbers]) for numbers, repeats in block.items]
    shared = rows.sparkSession.sparkContext.broadcast((len(block.terms), own))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, items = shared.value
        best = [Best.nothing() for _ in items]
        step = max(16, CELLS // max(1, width))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                n = part.column(1).to_numpy()
                none = np.asarray(part.column(0).is_null())
                doc = part.column(0).fill_null(0).to_numpy()
                found = part.column(2)
                lengths = np.diff(found.offsets.to_numpy())
                tf = np.zeros((part.num_rows, width), dtype=np.int32)
                tf[np.repeat(np.arange(part.num_rows), lengths), found.flatten().to_numpy()] = part.column(3).flatten().to_numpy()
                m = 25 + 75 * n * n_docs // n_terms
                for k, (numbers, weight) in enumerate(items):
                    if len(numbers):
                        search_batch(tf[:, numbers], m, none, doc, weight, best[k], top)
        sizes = [len(b.score) for b in best]
        nulls = np.concatenate([b.none for b in best])
        columns = [
            pa.array(np.repeat(np.arange(len(items)), sizes), pa.int64()),
            pa.array(np.concatenate([b.doc for b in best]), pa.int64(), mask=nulls),
            pa.array(np.concatenate([b.score for b in best]), pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])
        release_memory()

    return rows.mapInArrow(work, "item long, doc_id long, score long")


def search(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each row of ``benchmark``.

    Terms are alphanumeric or non-ASCII runs, A-Z lower-cased. A term that df of N documents with
    terms hold weighs floor(1000 ln((2N + 2) / (2 df + 1))); a document of n terms has
    m = 25 + 75 n N div L, L being all their terms; its score sums, over the item's terms, repeats
    included, weight * (10^9 tf div (1000 tf + 8 m)). Only scores above 0 rank; ties rank by
    ascending doc_id, null last. doc_id is read as a long.

    Every row is a document and every row of ``benchmark`` an item, repeated rows included; rows
    that tie in all get ranks in any order. Null and empty texts have no terms: they aren't
    documents, and items without terms have no rows. An empty table on either side: no rows.

    Items are broadcast in blocks of bounded size; each is one more pass over the texts.
    """
    spark = docs.sparkSession
    kind = benchmark.select(col(item).alias("item_id")).schema
    out = spark.createDataFrame([], f"item_id {kind[0].dataType.simpleString()}, rank int, doc_id long, score long")
    for block in blocks(benchmark, item, item_text):
        rows = written(postings(docs, doc_id, text, block.terms), "postings")
        totals = rows.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
        if not totals["docs"]:
            break
        held = rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
        weights = np.zeros(len(block.terms), dtype=np.int64)
        for term, df in held:  # one row per term of the block
            weights[term] = math.floor(1000 * math.log((2 * totals["docs"] + 2) / (2 * df + 1)))
        found = written(candidates(rows, block, weights, totals["docs"], totals["terms"], top), "candidates")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        names = spark.createDataFrame([(k, name) for k, name in enumerate(block.ids)], f"item long, item_id {kind[0].dataType.simpleString()}")
        out = out.unionByName(ranked.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return out
