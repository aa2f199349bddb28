"""Language-model scores: a log-bilinear model trained by noise-contrastive estimation.

Words are counted over all training texts. The most common words are symbols of their own, the
others share class symbols, told apart within their class by their counts. A log-bilinear model
over symbols predicts a symbol's vector from those of the two before it. Every task trains on all
texts of its partition, from common parameters, and the results are averaged by tokens.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import col, release_memory, text_of, written

END = b""  # the token after a text's last word; no word is empty
OWN, CLASSES = 448, 64
SYMBOLS = OWN + CLASSES
WIDTH = 16
HEAD_WORDS = 100_000  # broadcast, at most so many; the words beyond it are joined
STEPS = 32
NOISE, BATCH, RATE = 32, 1024, 0.15
COUNTED_AT_ONCE = 300_000
LN10 = float(np.log(10))


def tokens_of(text: str) -> list[bytes]:
    out = text.encode("utf-8", "surrogatepass").lower().split()
    out.append(END)
    return out


def class_of(word: bytes) -> int:
    """Class symbol of a word without its own: by its last two bytes."""
    return OWN + zlib.crc32(word[-2:]) % CLASSES


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def count_words(texts: DataFrame) -> DataFrame:
    """(word, c) over the column ``text``; combined per task, and again in the shuffle."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                counts.update(tokens_of(text))
                if len(counts) > COUNTED_AT_ONCE:
                    yield pd.DataFrame({"word": list(counts), "c": list(counts.values())})
                    counts = Counter()
        if counts:
            yield pd.DataFrame({"word": list(counts), "c": list(counts.values())})
        del counts
        release_memory()

    return texts.select("text").mapInPandas(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """The most common words with their symbols, and the totals of all."""

    index: dict[bytes, int]
    count: np.ndarray
    symbol: np.ndarray
    total: int
    distinct: int
    class_total: np.ndarray
    class_distinct: np.ndarray

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.total + 0.5 * (self.distinct + 1)))

    def within(self, c: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """log10 of a word's share of its symbol: 1 for words with a symbol of their own."""
        k = np.maximum(symbol.astype(np.int64) - OWN, 0)
        share = (c + 0.5) / (self.class_total[k] + 0.5 * (self.class_distinct[k] + 1))
        return np.where(symbol < OWN, 0.0, np.log10(share))

    def symbols_of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Places in the head (-1: none) and symbols."""
        get = self.index.get
        at = np.array([get(w, -1) for w in words], dtype=np.int64)
        symbol = self.symbol[at] if len(self.symbol) else np.zeros(len(at), dtype=np.int64)
        for k in np.flatnonzero(at < 0).tolist():
            symbol[k] = class_of(words[k])
        return at, symbol.astype(np.uint16)

    def unigram(self) -> np.ndarray:
        """Smoothed shares of the symbols in the training texts."""
        mass = np.full(SYMBOLS, 0.5)
        own = self.symbol < OWN
        np.add.at(mass, self.symbol[own], self.count[own])
        mass[OWN:] += self.class_total
        return mass / mass.sum()


def _class_column(word: Column) -> Column:
    last = F.when(F.octet_length(word) > 2, F.substring(word, -2, 2)).otherwise(word)
    return (F.crc32(last) % CLASSES).cast("int")


def vocabulary(counts: DataFrame, head_words: int = HEAD_WORDS) -> Vocabulary:
    """From the stored counts. The driver gets ``head_words`` rows at most, one per class, and one
    per step of the counts' scale, of which there are STEPS for each doubling."""
    totals = counts.agg(F.sum("c"), F.count("*")).first()
    step = F.floor(F.log2("c") * STEPS)
    left, least = head_words, None
    for value, n in sorted(counts.groupBy(step.alias("step")).agg(F.count("*")).collect(), reverse=True):
        if n > left:
            break
        left, least = left - n, value
    head = [] if least is None else counts.where(step >= least).collect()
    head = sorted((-r["c"], bytes(r["word"])) for r in head)
    words, count = [w for _, w in head], np.array([-c for c, _ in head], dtype=np.int64)
    symbol = np.array([k if k < OWN else class_of(w) for k, w in enumerate(words)], dtype=np.int64).reshape(-1)
    class_total, class_distinct = np.zeros(CLASSES), np.zeros(CLASSES)
    for k, c, n in counts.groupBy(_class_column(F.col("word"))).agg(F.sum("c"), F.count("*")).collect():
        class_total[k], class_distinct[k] = c, n
    for word, c in zip(words[:OWN], count[:OWN].tolist(), strict=True):
        class_total[class_of(word) - OWN] -= c
        class_distinct[class_of(word) - OWN] -= 1
    index = {w: k for k, w in enumerate(words)}
    return Vocabulary(index, count, symbol, int(totals[0] or 0), int(totals[1]), class_total, class_distinct)


class LogBilinear:
    """Parameters in one flat array: vectors of contexts and targets, biases, and the matrices
    that a context's place in the text has."""

    SHAPES = {"context": (SYMBOLS, WIDTH), "target": (SYMBOLS, WIDTH), "bias": (SYMBOLS,), "turn": (2, WIDTH, WIDTH)}

    def __init__(self, flat: np.ndarray):
        self.flat, at = flat, 0
        for name, shape in self.SHAPES.items():
            size = int(np.prod(shape))
            setattr(self, name, flat[at : at + size].reshape(shape))
            at += size

    @classmethod
    def size(cls) -> int:
        return sum(int(np.prod(s)) for s in cls.SHAPES.values())

    @classmethod
    def start(cls, unigram: np.ndarray, seed: int = 7) -> LogBilinear:
        """Small random vectors; biases such that the model begins as the unigram shares."""
        model = cls(np.random.default_rng(seed).normal(0, 0.1, cls.size()).astype(np.float32))
        model.bias[:] = np.log(unigram)
        model.turn[:] = np.eye(WIDTH, dtype=np.float32)
        return model

    def predicted(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Vector of the next symbol after ``two`` and then ``one``."""
        return (self.context @ self.turn[0])[one] + (self.context @ self.turn[1])[two]

    def log_normalisers(self) -> np.ndarray:
        """log of the sum over all symbols, for every pair of contexts, by batched matrix products."""
        near, far = self.context @ self.turn[0], self.context @ self.turn[1]
        out = np.empty((SYMBOLS, SYMBOLS), dtype=np.float32)
        for one in range(SYMBOLS):
            scores = (near[one] + far) @ self.target.T + self.bias
            top = scores.max(axis=1)
            out[one] = top + np.log(np.exp(scores - top[:, None]).sum(axis=1))
        return out


class Trainer:
    """Noise-contrastive estimation by mini-batches, steps scaled as Adagrad does."""

    def __init__(self, flat: np.ndarray, unigram: np.ndarray, seed: int):
        self.model = LogBilinear(flat.copy())
        self.noise = unigram
        self.log_noise = np.log(NOISE * unigram).astype(np.float32)
        self.cumulative = np.cumsum(unigram)
        self.squares = LogBilinear(np.full(len(flat), 1e-2, dtype=np.float32))
        self.random = np.random.default_rng(seed)

    def step(self, one: np.ndarray, two: np.ndarray, target: np.ndarray) -> None:
        m = self.model
        drawn = np.searchsorted(self.cumulative, self.random.random(NOISE) * self.cumulative[-1])
        drawn = np.minimum(drawn, SYMBOLS - 1)
        near, far = m.context[one], m.context[two]
        q = near @ m.turn[0] + far @ m.turn[1]
        data = np.einsum("ij,ij->i", q, m.target[target]) + m.bias[target] - self.log_noise[target]
        noise = q @ m.target[drawn].T + m.bias[drawn] - self.log_noise[drawn]
        # Of a data token the probability to be taken for noise, of noise that to be taken for data.
        miss = (1 / (1 + np.exp(np.clip(data, -30, 30)))).astype(np.float32)
        fooled = (-1 / (1 + np.exp(np.clip(-noise, -30, 30)))).astype(np.float32)
        dq = miss[:, None] * m.target[target] + fooled @ m.target[drawn]
        grads = LogBilinear(np.zeros(len(m.flat), dtype=np.float32))
        _add_rows(grads.target, target, miss[:, None] * q)
        np.add.at(grads.target, drawn, fooled.T @ q)
        grads.bias += np.bincount(target, weights=miss, minlength=SYMBOLS).astype(np.float32)
        np.add.at(grads.bias, drawn, fooled.sum(axis=0))
        _add_rows(grads.context, one, dq @ m.turn[0].T)
        _add_rows(grads.context, two, dq @ m.turn[1].T)
        grads.turn[0] += near.T @ dq
        grads.turn[1] += far.T @ dq
        g = grads.flat / np.float32(len(target))
        self.squares.flat += g * g
        m.flat += np.float32(RATE) * g / np.sqrt(self.squares.flat)


def _add_rows(into: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    order = np.argsort(rows, kind="stable")
    own = rows[order]
    first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
    into[own[first]] += np.add.reduceat(values[order], first, axis=0)


def _contexts(symbol: np.ndarray, begins: np.ndarray, end_symbol: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbols one and two before each; before a text's begin stand ends of text."""
    one, two = np.roll(symbol, 1), np.roll(symbol, 2)
    one[begins] = end_symbol
    two[begins] = end_symbol
    second = begins + 1
    second = second[second < len(symbol)]
    # A text of one token is followed by another text's begin, which is set already.
    two[second[~np.isin(second, begins)]] = end_symbol
    return one, two


def _token_arrays(vocabulary: Vocabulary, texts: list[str]):
    words: list[bytes] = []
    begins = []
    for text in texts:
        begins.append(len(words))
        words += tokens_of(text)
    at, symbol = vocabulary.symbols_of(words)
    begins = np.array(begins, dtype=np.int64)
    end = vocabulary.index.get(END, -1)
    end_symbol = int(vocabulary.symbol[end]) if end >= 0 else class_of(END)
    return words, begins, at, symbol, *_contexts(symbol, begins, end_symbol)


def _groups(texts, most: int = 1 << 21) -> Iterator[list[str]]:
    group, held = [], 0
    for text in texts:
        group.append(text)
        held += len(text)
        if held >= most:
            yield group
            group, held = [], 0
    if group:
        yield group


def train(texts: DataFrame, vocab, rounds: int = 1, merged: int = 32) -> LogBilinear:
    """The model after ``rounds`` passes over all of the column ``text``; ``vocab`` is a broadcast.

    A partition's result is one row of parameters. Rows are summed in groups of ``merged``, level
    by level, so that neither a task nor the driver gets more than that many.
    """
    context = texts.sparkSession.sparkContext
    model = LogBilinear.start(vocab.value.unigram())
    for _ in range(rounds):
        start = context.broadcast(model.flat)

        def learn(batches: Iterator[pd.DataFrame], start=start) -> Iterator[pd.DataFrame]:
            trainer = Trainer(start.value, vocab.value.unigram(), seed=11)
            seen = 0
            for batch in batches:
                for group in _groups(batch["text"]):
                    _, _, _, symbol, one, two = _token_arrays(vocab.value, group)
                    # A batch takes every n-th token, and so some of every text of the group.
                    n = -(-len(symbol) // BATCH)
                    for k in trainer.random.permutation(n).tolist():
                        trainer.step(one[k::n], two[k::n], symbol[k::n])
                    seen += len(symbol)
            if seen:
                flat = trainer.model.flat.astype(np.float64) * seen
                yield pd.DataFrame({"tokens": [seen], "flat": [flat.tolist()], "i": [TaskContext.get().partitionId()]})

        def add(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
            flat = np.sum(np.stack(group["flat"].to_list()), axis=0)
            return pd.DataFrame({"tokens": [int(group["tokens"].sum())], "flat": [flat.tolist()], "i": [key[0]]})

        shape = "tokens long, flat array<double>, i long"
        level = written(texts.select("text").mapInPandas(learn, shape), "trained")
        n = (level.agg(F.max("i")).first()[0] if not level.isEmpty() else -1) + 1
        if not n:
            break
        while n > merged:
            level = level.groupBy(F.expr(f"i div {merged}").alias("i")).applyInPandas(add, shape)
            n = -(-n // merged)
        rows = level.select("tokens", "flat").collect()
        flat = np.sum([np.array(r["flat"]) for r in rows], axis=0) / sum(r["tokens"] for r in rows)
        model = LogBilinear(flat.astype(np.float32))
    return model


def score_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", head_words: int = HEAD_WORDS, rounds: int = 1) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Tokens: runs without ASCII blanks, A-Z lower-cased, and one end per text; a null text has the
    end alone. Rows whose crc32(id) mod 5 is 1 are held out, all others (null ids too) are learned
    from. base_score: add-half unigram log10 probability. score: the model's log10 probability,
    the sum over tokens of log P(symbol | two symbols before) + log P(word | symbol), normalised
    over all symbols; unseen words have half a count in their class. n_known: tokens that occur in
    training. Repeated rows are scored, and counted, each. Without training rows both scores are
    finite: the counts are zero. Words that are not among the ``head_words`` most common are
    looked up by a join, per text and word once.
    """
    own = docs.select(col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    own = own.withColumn("held_out", held_out(F.col("doc_id")))
    training = own.where(~F.col("held_out"))
    counts = written(count_words(training), "counts")
    context = docs.sparkSession.sparkContext
    vocab = context.broadcast(vocabulary(counts, head_words))
    model = train(training, vocab, rounds)
    fixed = context.broadcast((model.flat, model.log_normalisers()))
    kind = own.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = vocab.value
        flat, normalisers = fixed.value
        m = LogBilinear(flat)
        near, far = m.context @ m.turn[0], m.context @ m.turn[1]
        head_base = v.base(v.count)
        head_within = v.within(v.count, v.symbol)
        for batch in batches:
            begin = 0
            for group in _groups(batch["text"]):
                part = batch.iloc[begin : begin + len(group)]
                begin += len(group)
                words, begins, at, symbol, one, two = _token_arrays(v, group)
                known = at >= 0
                logs = np.empty(len(symbol))
                for k in range(0, len(symbol), 1 << 16):
                    own = slice(k, k + (1 << 16))
                    q = near[one[own]] + far[two[own]]
                    logs[own] = np.einsum("ij,ij->i", q, m.target[symbol[own]]) + m.bias[symbol[own]]
                logs = (logs - normalisers[one, two]) / LN10
                if len(head_within):
                    logs += np.where(known, head_within[at], 0.0)
                base = np.where(known, head_base[at], 0.0) if len(head_base) else np.zeros(len(at))
                ends = np.append(begins[1:], len(words))
                rare: list[list] = []
                missing = np.flatnonzero(~known)
                cuts = np.searchsorted(missing, np.append(begins, len(words))).tolist()
                for i, j in zip(cuts, cuts[1:], strict=False):
                    tf = Counter([words[k] for k in missing[i:j].tolist()])
                    rare.append(list(tf.items()))
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"].to_numpy(),
                        "held_out": part["held_out"].to_numpy(),
                        "n_tokens": ends - begins,
                        "head_tokens": np.add.reduceat(known.astype(np.int64), begins),
                        "head_base": np.add.reduceat(base, begins),
                        "head_score": np.add.reduceat(logs, begins),
                        "rare": rare,
                    }
                )
        release_memory()

    schema = (
        "doc_id string, held_out boolean, n_tokens long, head_tokens long, head_base double, head_score double,"
        " rare array<struct<word: binary, n: long>>"
    )
    scored = own.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(score, schema)
    scored = written(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    v = vocab.value
    rare = scored.select("row", F.inline("rare"))
    classes = docs.sparkSession.createDataFrame(
        [(k, float(v.class_total[k] + 0.5 * (v.class_distinct[k] + 1))) for k in range(CLASSES)], "class int, mass double"
    )
    looked_up = rare.join(counts, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    looked_up = looked_up.withColumn("class", _class_column(F.col("word"))).join(F.broadcast(classes), "class")
    mass = v.total + 0.5 * (v.distinct + 1)
    by_row = looked_up.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("n") * F.log10((F.col("c") + 0.5) / F.lit(mass))).alias("rare_base"),
        F.sum(F.col("n") * F.log10((F.col("c") + 0.5) / F.col("mass"))).alias("rare_score"),
    )
    zero = F.lit(0)
    return scored.drop("rare").join(by_row, "row", "left").select(
        F.col("doc_id").cast(kind).alias("doc_id"),
        "held_out",
        "n_tokens",
        (F.col("head_tokens") + F.coalesce("rare_known", zero)).alias("n_known"),
        F.lit(v.total).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("rare_base", zero)).alias("base_score"),
        (F.col("head_score") + F.coalesce("rare_score", zero)).alias("score"),
    )
