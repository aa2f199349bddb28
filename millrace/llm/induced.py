"""External induced suffix sorting of one shard, with common-prefix values.

The shard's text lies in a file and is read through a memory map, as are all arrays of its size;
queues keep a bounded part in memory and append the rest to files. So a shard may be far larger
than the memory of the task that sorts it. Files are private to the task and go with it.

Steps: suffixes are classed S (smaller than their successor) or L; the S* suffixes (S after L)
are ordered by naming the substrings between them and refining the names over 1, 2, 4, ...
substrings; their order is then induced onto the L suffixes, smallest first, and from these onto
the S suffixes, largest first. A queue of suffix tuples (position, common prefix with the tuple
before it), ordered by first byte and arrival, takes the place of the suffix array's buckets.
Orders and common prefixes are exact up to ``cap`` bytes, which is all that a caller asks for.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np

SEPARATOR = 0xFF  # ends every string of the shard; greater than any byte of UTF-8
BLOCK = 1 << 16
BUFFERED = 1 << 20  # tuples of a queue that stay in memory
SORTED_AT_ONCE = 1 << 23  # elements of an in-memory sort; larger sorts are dealt out first

TUPLE = np.dtype([("at", np.int64), ("lcp", np.int16)])


class Scratch:
    """Memory-mapped arrays and queue files in a folder of the task's own, removed on exit."""

    def __enter__(self) -> Scratch:
        self._folder = tempfile.TemporaryDirectory(prefix="suffix-")
        self._made = 0
        return self

    def __exit__(self, *_) -> None:
        self._folder.cleanup()

    def path(self) -> str:
        self._made += 1
        return os.path.join(self._folder.name, str(self._made))

    def array(self, n: int, dtype) -> np.ndarray:
        return np.memmap(self.path(), dtype=dtype, mode="w+", shape=(max(n, 1),))[:n]


class Queue:
    """Tuples in order of arrival; what exceeds the buffer lies in a file."""

    def __init__(self, scratch: Scratch):
        self._scratch, self._file, self._buffer, self._held, self.length = scratch, None, [], 0, 0

    def push(self, at: np.ndarray, lcp: np.ndarray) -> None:
        item = np.empty(len(at), dtype=TUPLE)
        item["at"], item["lcp"] = at, lcp
        self._buffer.append(item)
        self._held += len(item)
        self.length += len(item)
        if self._held > BUFFERED:
            self._file = self._file or open(self._scratch.path(), "w+b", buffering=0)  # noqa: SIM115
            self._file.seek(0, os.SEEK_END)
            for part in self._buffer:
                self._file.write(part.tobytes())
            self._buffer, self._held = [], 0

    def _piece(self, begin: int, end: int) -> np.ndarray:
        """Tuples begin to end, from the file or from the buffer (never from both)."""
        stored = self.length - self._held
        if begin < stored:
            self._file.seek(begin * TUPLE.itemsize)
            return np.frombuffer(self._file.read((end - begin) * TUPLE.itemsize), dtype=TUPLE)
        if len(self._buffer) > 1:
            self._buffer = [np.concatenate(self._buffer)]
        return self._buffer[0][begin - stored : end - stored]

    def block(self, begin: int) -> np.ndarray:
        """Tuples from number ``begin``: a block of them, or as far as the file goes."""
        stored = self.length - self._held
        return self._piece(begin, min(begin + BLOCK, stored if begin < stored else self.length))

    def descending(self) -> Iterator[np.ndarray]:
        stored, end = self.length - self._held, self.length
        while end:
            begin = max(end - BLOCK, stored if end > stored else 0)
            yield self._piece(begin, end)[::-1]
            end = begin

    def close(self) -> None:
        if self._file:
            self._file.close()
        self._buffer = []


def external_order(keys: np.ndarray, scratch: Scratch) -> np.ndarray:
    """Indices that sort ``keys``; dealt into ranges of keys when there are many."""
    n = len(keys)
    if n <= SORTED_AT_ONCE:
        return np.argsort(keys)
    sample = np.sort(keys[:: max(1, n // 4096)])
    parts = n // (SORTED_AT_ONCE // 4) + 1
    cuts = np.unique(sample[np.linspace(0, len(sample) - 1, parts + 1).astype(int)[1:-1]])
    dealt = np.searchsorted(cuts, keys, side="right")
    out, done = scratch.array(n, np.int64), 0
    for part in range(len(cuts) + 1):
        own = np.flatnonzero(dealt == part)
        out[done : done + len(own)] = own[np.argsort(keys[own])]
        done += len(own)
    return out


def dense(keys: np.ndarray, scratch: Scratch) -> np.ndarray:
    """Numbers from 0 without gaps in the order of ``keys``."""
    order = external_order(keys, scratch)
    own = keys[order]
    out = np.empty(len(keys), dtype=np.int64)
    out[order] = np.cumsum(np.concatenate(([0], own[1:] != own[:-1])))
    return out


class Shard:
    """A text of strings that each end with SEPARATOR, and the order of its suffixes."""

    def __init__(self, text: np.ndarray, scratch: Scratch, cap: int):
        self.n, self.cap, self.scratch = len(text), cap, scratch
        # A margin of zero bytes lets words of 8 bytes be read at every position.
        self.text = scratch.array(self.n + 8, np.uint8)
        self.text[: self.n] = text
        self.words = np.ndarray((self.n + 1,), dtype=">u8", buffer=self.text.data, strides=(1,))
        self.is_s = self._classify()

    def _classify(self) -> np.ndarray:
        """True for S suffixes. Runs of one byte have the type of their last position."""
        is_s, n = self.scratch.array(self.n, bool), self.n
        carry = False
        for end in range(n, 0, -(1 << 22)):
            begin = max(0, end - (1 << 22))
            own = self.text[begin:end].astype(np.int16)
            after = np.empty_like(own)
            after[:-1] = own[1:]
            after[-1] = self.text[end] if end < n else -1
            differs = np.flatnonzero(own != after)
            smaller = own < after
            slot = np.searchsorted(differs, np.arange(len(own)))
            known = slot < len(differs)
            part = np.full(len(own), carry)
            part[known] = smaller[differs[slot[known]]]
            is_s[begin:end] = part
            carry = bool(part[0])
        return is_s

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefix of the suffixes at ``a`` and ``b``, at most ``cap``; 8 bytes a step."""
        out = np.zeros(len(a), dtype=np.int64)
        todo = np.arange(len(a))
        while len(todo):
            x, y = a[todo] + out[todo], b[todo] + out[todo]
            inside = np.maximum(x, y) <= self.n - 8
            gone = todo[~inside]
            for k in gone:  # near the end of the text, byte by byte
                i, j = int(a[k] + out[k]), int(b[k] + out[k])
                while max(i, j) < self.n and out[k] < self.cap and self.text[i] == self.text[j]:
                    i, j, out[k] = i + 1, j + 1, out[k] + 1
            todo, x, y = todo[inside], x[inside], y[inside]
            d = self.words[x].astype(np.uint64) ^ self.words[y].astype(np.uint64)
            same = d == 0
            top = np.zeros(len(d), dtype=np.int64)
            for k in range(1, 8):
                top += d < (np.uint64(1) << np.uint64(64 - 8 * k))
            out[todo] += np.where(same, 8, top)
            todo = todo[same & (out[todo] < self.cap)]
        return np.minimum(out, self.cap)

    def _names(self, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Order of the substrings [at, end]; a substring that begins another comes after it.

        Equal substrings get one name. Names are places in the sorted order.
        """
        size = end - at + 1

        def word(of: np.ndarray, step: int) -> np.ndarray:
            left = np.clip(size[of] - 8 * step, 0, 8).astype(np.uint64)
            from_ = np.minimum(at[of] + 8 * step, self.n)
            pad = np.where(left == 8, np.uint64(0), np.uint64(0xFFFFFFFFFFFFFFFF) >> (left * np.uint64(8) % np.uint64(64)))
            return self.words[from_].astype(np.uint64) | pad

        everyone = np.arange(len(at))
        rank = _refined(np.zeros(len(at), dtype=np.int64), dense(word(everyone, 0), self.scratch), everyone, self.scratch)
        step = 1
        while True:
            longer = np.zeros(len(at), dtype=bool)
            longer[rank[size > 8 * step]] = True
            active = np.flatnonzero(longer[rank])
            if not len(active) or 8 * step > self.cap:
                return rank
            rank = _refined(rank, dense(word(active, step), self.scratch), active, self.scratch)
            step += 1

    def star_order(self) -> tuple[np.ndarray, np.ndarray]:
        """S* suffixes in order, and the common prefix of each with the one before."""
        stars = np.flatnonzero(self.is_s[1:] & ~self.is_s[:-1]) + 1
        if not len(stars):
            return stars, stars
        # The last one takes the zero byte after the text with it: the end is smaller than any byte.
        ends = np.append(stars[1:], self.n)
        rank = self._names(stars, ends)
        reach = 1
        where = np.append(stars, self.n)
        while True:
            # Names of `reach` substrings; those still shared, and shorter than the cap, are refined.
            count = np.bincount(rank, minlength=len(stars))
            spans = where[np.minimum(np.arange(len(stars)) + reach, len(stars))] - stars
            active = np.flatnonzero((count[rank] > 1) & (spans < self.cap))
            if not len(active):
                break
            # A name may be refined only as a whole.
            shared = np.zeros(len(stars), dtype=bool)
            shared[rank[active]] = True
            active = np.flatnonzero(shared[rank])
            after = active + reach
            follow = np.where(after < len(stars), rank[np.minimum(after, len(stars) - 1)] + 1, 0)
            rank = _refined(rank, follow, active, self.scratch)
            reach *= 2
        place = external_order(rank, self.scratch)
        order, rank = stars[place], rank[place]
        # Those that still share a name share all bytes up to the cap.
        lcp = np.full(len(order), self.cap, dtype=np.int64)
        lcp[0] = 0
        apart = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        for begin in range(0, len(apart), 1 << 20):
            own = apart[begin : begin + (1 << 20)]
            lcp[own] = self.common(order[own - 1], order[own])
        return order, lcp

    def run_length(self, at: int) -> int:
        byte, k = self.text[at], 0
        while k < self.cap and at + k < self.n and self.text[at + k] == byte:
            k += 1
        return k

    def sorted_suffixes(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Suffixes in descending order, in blocks of (position, prefix shared with the next smaller
        one ahead of it in that order, that is with the one given before)."""
        order, star_lcp = self.star_order()
        bounds = np.searchsorted(self.text[order], np.arange(257)) if len(order) else np.zeros(257, dtype=int)
        smaller = [Queue(self.scratch) for _ in range(256)]
        induce = _Induction(self, smaller, want_s=False)
        induce(np.array([self.n], dtype=np.int64), np.zeros(1, dtype=np.int64))
        for byte in range(256):
            last = _drain(smaller[byte], induce)
            own = slice(bounds[byte], bounds[byte + 1])
            at, lcp = order[own], star_lcp[own].copy()
            if len(at):
                lcp[0] = min(self.run_length(last), self.run_length(int(at[0]))) if last is not None else 0
                for k in range(0, len(at), BLOCK):
                    induce(at[k : k + BLOCK], lcp[k : k + BLOCK])
        larger = [Queue(self.scratch) for _ in range(256)]
        induce = _Induction(self, larger, want_s=True)
        for byte in range(255, -1, -1):
            seen, last = 0, None
            while seen < larger[byte].length:
                block = larger[byte].block(seen)
                seen += len(block)
                at, lcp = block["at"], block["lcp"].astype(np.int64)
                induce(at, lcp)
                last = int(at[-1])
                yield at, lcp
            # An L suffix's stored value is shared with the one below it; shift to the one above.
            above = 0
            for block in smaller[byte].descending():
                at = block["at"]
                lcp = np.empty(len(at), dtype=np.int64)
                lcp[0] = above
                lcp[1:] = block["lcp"][:-1]
                if last is not None:
                    lcp[0] = min(self.run_length(last), self.run_length(int(at[0])))
                    last = None
                above = int(block["lcp"][-1])
                induce(at, lcp)
                yield at, lcp
            smaller[byte].close()
            larger[byte].close()


def _drain(queue: Queue, induce: _Induction) -> int | None:
    """Induce from a bucket until nothing is added to it; its last suffix."""
    seen, last = 0, None
    while seen < queue.length:
        block = queue.block(seen)
        seen += len(block)
        induce(block["at"], block["lcp"].astype(np.int64))
        last = int(block["at"][-1])
    return last


def _refined(rank: np.ndarray, key: np.ndarray, active: np.ndarray, scratch: Scratch) -> np.ndarray:
    """``rank`` with the names of ``active`` elements split by ``key``, which is below 2**32.

    A name is the place of its first element in the order, so that splitting one leaves all
    others as they are.
    """
    pair = (rank[active] << 32) | key
    order = external_order(pair, scratch)
    own = pair[order]
    places = np.arange(len(own))
    new_name = np.concatenate(([True], own[1:] >> 32 != own[:-1] >> 32))
    new_key = np.concatenate(([True], own[1:] != own[:-1]))
    group = np.maximum.accumulate(np.where(new_name, places, 0))
    first = np.maximum.accumulate(np.where(new_key, places, 0))
    out = rank.copy()
    out[active[order]] = (own >> 32) + (first - group)
    return out


class _Induction:
    """Pushes the predecessors of popped suffixes, each with its common prefix.

    Two predecessors with one first byte share one byte more than their successors do, and these
    share the least of the values popped between them.
    """

    def __init__(self, shard: Shard, queues: list[Queue], want_s: bool):
        self.shard, self.queues, self.want_s = shard, queues, want_s
        # Least value popped since the last push to a bucket; -1 stands before its first push.
        self.least = np.full(256, -1, dtype=np.int64)

    def __call__(self, at: np.ndarray, lcp: np.ndarray) -> None:
        shard = self.shard
        before = at - 1
        ok = before >= 0
        ok[ok] = shard.is_s[before[ok]] == self.want_s
        index = np.flatnonzero(ok)
        low = np.minimum.accumulate(lcp)
        if len(index):
            byte = shard.text[before[index]]
            order = np.argsort(byte, kind="stable")
            index, byte = index[order], byte[order]
            head = np.empty(len(index), dtype=bool)
            head[0] = True
            head[1:] = byte[1:] != byte[:-1]
            value = np.empty(len(index), dtype=np.int64)
            value[head] = np.minimum(self.least[byte[head]], low[index[head]])
            inner = np.flatnonzero(~head)
            value[inner] = _range_min(lcp, index[inner - 1] + 1, index[inner] + 1)
            value = np.minimum(value + 1, shard.cap)
            starts = np.flatnonzero(head)
            stops = np.append(starts[1:], len(index))
            high = np.minimum.accumulate(lcp[::-1])[::-1]
            present = byte[starts]
            np.minimum(self.least, low[-1], out=self.least)
            for b, i, j in zip(present.tolist(), starts.tolist(), stops.tolist(), strict=True):
                self.queues[b].push(before[index[i:j]], value[i:j])
                k = index[j - 1] + 1
                self.least[b] = high[k] if k < len(lcp) else shard.cap
        else:
            np.minimum(self.least, low[-1], out=self.least)


def _range_min(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Least of values[begin:end] for each pair, by a table of minima over powers of two."""
    out = np.empty(len(begin), dtype=np.int64)
    width = end - begin
    level = np.frexp(width)[1] - 1
    table = values.astype(np.int16)
    for k in range(int(level.max()) + 1 if len(level) else 0):
        own = np.flatnonzero(level == k)
        if len(own):
            out[own] = np.minimum(table[begin[own]], table[end[own] - (1 << k)])
        if len(table) > 1 << k:
            table = np.minimum(table[: -(1 << k)], table[1 << k :])
    return out


def repeated_starts(shard: Shard, eligible: np.ndarray, weight_of) -> np.ndarray:
    """Flags of the text's positions: ``eligible`` ones whose ``cap`` bytes start at another
    eligible position, too, or whose own weight is over one.

    Suffixes with equal ``cap`` bytes follow each other in order; ``weight_of`` maps positions to
    the number of places in the input that they stand for.
    """
    flags = shard.scratch.array(shard.n, bool)
    flags[:] = False
    group, last_group, last_at = 0, -1, -1
    for at, lcp in shard.sorted_suffixes():
        groups = group + np.cumsum(lcp < shard.cap)
        group = int(groups[-1])
        own = eligible[at]
        at, groups = at[own], groups[own]
        if not len(at):
            continue
        flags[at] = weight_of(at) > 1
        twin = np.flatnonzero(groups[1:] == groups[:-1])
        flags[at[twin]] = True
        flags[at[twin + 1]] = True
        if groups[0] == last_group:
            flags[at[0]] = True
            flags[last_at] = True
        last_group, last_at = int(groups[-1]), int(at[-1])
    return flags
