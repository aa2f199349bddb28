"""Benchmark decontamination: a broadcast set of benchmark word windows, scanned over all texts."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import FOLD, col, cut, fresh, held, release_memory, text_of

RESULT = (
    "n_words long, n_hit long, items array<string>,"
    " hits array<struct<first: long, last: long>>, spans array<struct<start: long, end: long>>"
)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split()


class WindowIndex:
    """Hash set of the windows of some benchmark items.

    Words are numbered, a window is hashed as a polynomial of its words' numbers. The multiplier
    is chosen such that different windows have different hashes, and a hit is verified word by word.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], size: int):
        self.word: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, words in items:
            ids = [self.word.setdefault(w, len(self.word)) for w in words]
            for i in range(max(1, len(ids) - size + 1) if ids else 0):
                of = owners.setdefault(tuple(ids[i : i + size]), set())
                if item is not None:
                    of.add(item)
        self.groups = []
        for length in sorted({len(w) for w in owners}):
            windows = [w for w in owners if len(w) == length]
            matrix = np.array(windows, dtype=np.int64)
            for attempt in range(64):
                powers = self._powers(length, attempt)
                hashes = (matrix.astype(np.uint64) * powers).sum(axis=1, dtype=np.uint64)
                if len(np.unique(hashes)) == len(hashes):
                    break
            else:
                raise RuntimeError("no multiplier keeps the windows apart")
            order = np.argsort(hashes)
            self.groups.append(
                (length, powers, hashes[order], matrix[order], [sorted(owners[windows[k]]) for k in order])
            )

    @staticmethod
    def _powers(length: int, attempt: int) -> np.ndarray:
        base = 0x9E3779B97F4A7C15 + 2 * attempt
        return np.array([pow(base, j, 1 << 64) for j in range(1, length + 1)], dtype=np.uint64)

    def find(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, list]]:
        """(length, starts, rows, owners) of the windows in ``ids``; -1 is a word of no item."""
        unknown = np.where(ids < 0, np.arange(len(ids)), -1)
        last_unknown = np.maximum.accumulate(unknown) if len(ids) else unknown
        run = np.arange(len(ids)) - last_unknown
        for length, powers, hashes, matrix, owners in self.groups:
            starts = np.flatnonzero(run >= length) - (length - 1)
            if not len(starts):
                continue
            found = np.zeros(len(starts), dtype=np.uint64)
            for j in range(length):
                found += ids[starts + j].astype(np.uint64) * powers[j]
            rows = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
            hit = hashes[rows] == found
            starts, rows = starts[hit], rows[hit]
            same = np.ones(len(starts), dtype=bool)
            for j in range(length):
                same &= ids[starts + j] == matrix[rows, j]
            yield length, starts[same], rows[same], owners


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of True as (first, last)."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist(), strict=True))


def _byte_spans(folded: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    codes = np.frombuffer(folded, dtype=np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([0], codes.view(np.int8), [0]))))
    starts, ends = edges[::2], edges[1::2]
    return [(int(starts[a]), int(ends[b])) for a, b in runs]


def scan_texts(index: WindowIndex, texts: list[str], before: list | None) -> list[tuple]:
    """One RESULT per text. ``before`` has the results of earlier blocks, to be added to."""
    known = index.word
    folded = [t.encode("utf-8", "surrogatepass").translate(FOLD) for t in texts]
    words = [f.split() for f in folded]
    # All texts in one array; a word of no item between two texts keeps windows from crossing.
    sizes = np.array([len(w) + 1 for w in words], dtype=np.int64)
    begins = np.concatenate(([0], np.cumsum(sizes)))
    ids = np.fromiter(
        chain.from_iterable([*map(known.get, w, [-1] * len(w)), -1] for w in words),
        dtype=np.int64,
        count=int(begins[-1]),
    )
    change = np.zeros(len(ids) + 1, dtype=np.int64)
    items: dict[int, set[str]] = {}
    for length, starts, rows, owners in index.find(ids):
        np.add.at(change, starts, 1)
        np.add.at(change, starts + length, -1)
        texts_hit = np.searchsorted(begins, starts, side="right") - 1
        pairs = np.unique(np.stack([texts_hit, rows], axis=1), axis=0)
        for k, row in pairs.tolist():
            items.setdefault(k, set()).update(owners[row])
    covered = np.cumsum(change[:-1]) > 0
    out = []
    for k, f in enumerate(folded):
        n = len(words[k])
        earlier = before[k] if before is not None else None
        if k not in items and not (earlier and earlier["n_hit"]):
            out.append((n, 0, [], [], []))
            continue
        flags = covered[begins[k] : begins[k] + n].copy()
        names = items.get(k, set())
        if earlier:
            names = names | set(earlier["items"])
            for run in earlier["hits"]:
                flags[run["first"] : run["last"] + 1] = True
        runs = _runs(flags)
        out.append((n, int(flags.sum()), sorted(names), runs, _byte_spans(f, runs)))
    return out


def _blocks(benchmark: DataFrame, item: str, text: str, most: int) -> Iterator[list]:
    """Items in blocks of at most ``most`` words (or one item), streamed partition by partition."""
    block, words = [], 0
    rows = benchmark.select(col(item).cast("string"), text_of(text)).toLocalIterator()
    for name, body in rows:
        own = words_of(body)
        if block and words + len(own) > most:
            yield block
            block, words = [], 0
        if own:
            block.append((name, own))
            words += len(own)
    if block:
        yield block


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    size: int = 10,
    block_words: int = 2_000_000,
) -> Column:
    """A column with RESULT for each text of ``docs``.

    Words are alphanumeric or non-ASCII runs, A-Z lower-cased. An item's windows are its runs of
    ``size`` words; a shorter item is one window. n_hit: words inside an occurrence of a window;
    items: ids, as sorted distinct strings, of items with such windows (an item without an id hits
    but is not listed); hits: maximal runs of hit words; spans: the same in bytes of the text.

    The benchmark is broadcast in blocks of ``block_words`` words at most, which bounds a worker's
    memory; each block is one more scan over the texts, that adds to the earlier blocks' results.
    Null or empty text: no words. Empty benchmark: no hits. Repeated items or rows change nothing.
    """
    context = docs.sparkSession.sparkContext
    result = None
    for block in _blocks(benchmark, item, item_text, block_words):
        shared = context.broadcast(WindowIndex(block, size))
        result = _scanned(shared)(text_of(text)) if result is None else _added(shared)(text_of(text), result)
    return _scanned(context.broadcast(WindowIndex([], size)))(text_of(text)) if result is None else result


COLUMNS = ["n_words", "n_hit", "items", "hits", "spans"]


def _scanned(shared):
    @F.pandas_udf(RESULT)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(scan_texts(shared.value, list(texts), None), columns=COLUMNS)
        release_memory()

    return scan


def _added(shared):
    @F.pandas_udf(RESULT)
    def scan(batches: Iterator[tuple[pd.Series, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
        for texts, before in batches:
            found = scan_texts(shared.value, list(texts), before.to_dict("records"))
            yield pd.DataFrame(found, columns=COLUMNS)

    return scan


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    drop_share: float = 0.5,
    **options,
) -> DataFrame:
    """``docs`` without benchmark passages; same columns.

    A document of whose words ``drop_share`` or more are hit goes; of the others the hit spans
    go, other bytes stay. Documents without hits are returned unchanged, null texts included.
    """
    (found,) = fresh(docs, "found")
    marked = held(docs, found, find_contamination(docs, benchmark, text, **options))
    n_hit, n_words = F.col(f"{found}.n_hit"), F.col(f"{found}.n_words")
    kept = marked.where((n_hit == 0) | (n_hit < F.lit(drop_share) * n_words))
    body = F.when(n_hit == 0, col(text)).otherwise(cut(text_of(text), F.col(f"{found}.spans")))
    return kept.withColumn(text, body).drop(found)
