"""Byte-level BPE: a sentencepiece model made from a rank file, used to encode and decode.

The model file is not trained but serialised from the vocabulary: every byte has a character of
its own, each vocabulary entry becomes a piece of such characters with the negative rank as its
score, and the normaliser is the identity. Merging the best-scored adjacent pair, leftmost first,
is then merging the lowest rank, as byte-level BPE does.
"""

from __future__ import annotations

import base64
import functools
import struct
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fresh, release_memory, text_of

# Characters that stand for the 256 bytes; all are letters, none is special to sentencepiece.
FIRST_BYTE_CHAR = 0x100
BYTE_CHARS = {b: FIRST_BYTE_CHAR + b for b in range(256)}
# Distinct pre-tokens that a worker remembers; beyond it, the memory is emptied and fills anew.
REMEMBERED = 150_000
TOGETHER = 1_000_000


def read_ranks(lines: Iterable[bytes]) -> list[bytes]:
    """Token bytes in the order of their ranks, from lines of "base64 rank"."""
    ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without gaps")
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def serialise_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece model (protocol buffer) whose piece ``rank + 1`` is the token of that rank."""
    # Field numbers and enumerations of the public model format.
    normal, unknown, bpe = 1, 2, 2
    out = [_block(1, _block(1, b"<unk>") + _number(3, unknown))]
    for rank, token in enumerate(tokens):
        piece = token.decode("latin-1").translate(BYTE_CHARS).encode()
        score = _varint(2 << 3 | 5) + struct.pack("<f", -rank)
        out.append(_block(1, _block(1, piece) + score + _number(3, normal)))
    trainer = _number(3, bpe) + _number(4, len(tokens) + 1) + _number(40, 0)
    trainer += _number(41, -1) + _number(42, -1) + _number(43, -1)
    normalizer = _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join([*out, _block(2, trainer), _block(3, normalizer)])


def ascii_pattern(pattern: str) -> str:
    r"""``pattern`` for ASCII texts, in the faster standard engine: \p{L}, \p{N}, \s and \S spelled out."""
    classes = {r"\p{L}": "A-Za-z", r"\p{N}": "0-9", r"\s": r" \t-\r"}
    out, inside, i = [], False, 0
    while i < len(pattern):
        name = next((c for c in classes if pattern.startswith(c, i)), None)
        if name:
            out.append(classes[name] if inside else f"[{classes[name]}]")
        elif pattern.startswith(r"\S", i) and not inside:
            name = r"\S"
            out.append(r"[^ \t-\r]")
        else:
            name = pattern[i : i + 2] if pattern[i] == "\\" else pattern[i]
            inside = name == "[" or inside and name != "]"
            out.append(name)
        i += len(name)
    return "".join(out)


class Codec:
    """Encoder and decoder over one vocabulary, with a memory of pre-tokens it has met."""

    def __init__(self, tokens: list[bytes], pattern: str):
        import re

        import regex
        import sentencepiece

        self.tokens = tokens
        self.whole = {token: rank for rank, token in enumerate(tokens)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(tokens))
        self.split = regex.compile(pattern).findall
        self.split_ascii = re.compile(ascii_pattern(pattern)).findall
        self.known: dict[str, bytes] = {}

    def _learn(self, parts: set[str]) -> None:
        todo = []
        for part in parts:
            # A pre-token that is itself a vocabulary entry is that entry, even if merges miss it.
            rank = self.whole.get(part.encode("utf-8", "surrogatepass"))
            if rank is None:
                todo.append(part)
            else:
                self.known[part] = struct.pack("<I", rank)
        spelled = [p.encode("utf-8", "surrogatepass").decode("latin-1").translate(BYTE_CHARS) for p in todo]
        for part, pieces in zip(todo, self.model.encode(spelled, num_threads=1) if todo else [], strict=True):
            self.known[part] = struct.pack(f"<{len(pieces)}I", *[p - 1 for p in pieces])

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers.

        Texts are taken in groups of about TOGETHER characters, so that the model gets many new
        pre-tokens in one call and no more than a group's pre-tokens are held at once.
        """
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= TOGETHER:
                yield from self._encode_group(group)
                group, size = [], 0
        yield from self._encode_group(group)

    def _encode_group(self, texts: list[str]) -> Iterator[bytes]:
        split = [self.split_ascii(t) if t.isascii() else self.split(t) for t in texts]
        distinct = set().union(*split)
        new = distinct.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = distinct
        self._learn(new)
        known = self.known.__getitem__
        for parts in split:
            yield b"".join(map(known, parts))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I").tolist()))


@functools.lru_cache(maxsize=2)
def _codec(vocabulary: tuple[str, int], load: _Shared) -> Codec:
    return Codec(read_ranks(load.handle.value.splitlines()), load.pattern)


class _Shared:
    """A broadcast rank file; equal for the cache, which goes by what it holds."""

    def __init__(self, handle, pattern: str):
        self.handle, self.pattern = handle, pattern

    def __hash__(self) -> int:
        return hash(self.pattern)

    def __eq__(self, other) -> bool:
        return self.pattern == other.pattern

    def codec(self, key: tuple[str, int]) -> Codec:
        return _codec(key, self)


class BytePairCodec:
    """Encode and decode columns with the vocabulary in a rank file.

    The file is read on the driver and broadcast: a vocabulary, of a few megabytes at most
    (``max_bytes``), whatever the number of documents. Texts are encoded whole, one pre-token at
    a time; null counts as empty, an empty text has no ids. Ids are held as binary, four bytes
    each, lowest first; decoding gives the text's UTF-8 bytes back. Repeated rows and other
    columns are kept as they are.
    """

    def __init__(self, df: DataFrame, path: str, pattern: str, max_bytes: int = 64 << 20):
        import zlib

        with open(path, "rb") as file:
            ranks = file.read(max_bytes + 1)
        if len(ranks) > max_bytes:
            raise ValueError(f"{path} has more than {max_bytes} bytes")
        self._key = (pattern, zlib.crc32(ranks) << 32 | len(ranks))
        self._shared = _Shared(df.sparkSession.sparkContext.broadcast(ranks), pattern)

    def encode(self, text: Column) -> Column:
        key, shared = self._key, self._shared

        @F.pandas_udf("binary")
        def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            codec = shared.codec(key)
            for texts in batches:
                yield pd.Series(list(codec.encode(texts)), dtype=object)
            codec.known.clear()
            release_memory()

        return ids(text)

    def decode(self, ids: Column) -> Column:
        key, shared = self._key, self._shared

        @F.pandas_udf("binary")
        def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            codec = shared.codec(key)
            for values in batches:
                yield pd.Series([codec.decode(v or b"") for v in values], dtype=object)
            release_memory()

        return texts(ids)


def encode(
    docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str | None = "decoded"
) -> DataFrame:
    """``docs`` with its texts' ids and, unless ``decoded`` is None, the bytes decoded from them.

    Where ``docs`` has a column of such a name, underscores are put before the new one's.
    """
    codec = BytePairCodec(docs, path, pattern)
    names = fresh(docs, ids, *([decoded] if decoded else []))
    out = docs.withColumn(names[0], codec.encode(text_of(text)))
    if decoded:
        out = out.withColumn(names[1], codec.decode(F.col(names[0])))
    return out
