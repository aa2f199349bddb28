"""Plain versions of the operators, for small tables, written from their definitions."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    n = len(words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def licence(text):
    words = TERM.findall(fold(text))
    places, labels = [], set()
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        p = phrase.split()
        own = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += own
        labels |= {label} if own else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def repeats(texts, length):
    """Spans of each text's bytes that repeated strings cover."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        spans = []
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], i + length)
                else:
                    spans.append((i, i + length))
        out.append(spans)
    return out


def kept_bytes(text, spans):
    raw, at, out = (text or "").encode(), 0, b""
    for a, b in spans:
        out += raw[at:a]
        at = b
    return out + raw[at:]


def simhash(text):
    words = WORD.findall(fold(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), seed=42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def near_duplicates(rows):
    """(doc_id, fingerprint, component) with all pairs compared."""
    prints = [simhash(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            r = find(k)
            least[r] = min(least.get(r, doc_id), doc_id)
    return [(rows[k][0], f"{prints[k]:016x}", least.get(find(k))) for k in range(len(rows))]


def contamination(docs, items, size=10):
    windows = {}
    for item, text in items:
        words = TERM.findall(fold(text))
        for i in range(max(1, len(words) - size + 1) if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(item)
    lengths = sorted({len(w) for w in windows})
    out = []
    for doc_id, text in docs:
        words, hit, found = TERM.findall(fold(text)), set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if (of := windows.get(tuple(words[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    found |= of
        names = sorted(str(i) for i in found if i is not None)
        out.append((doc_id, len(words), len(hit), len(names), sha(",".join(names)), bool(hit)))
    return out


def unigram(rows):
    tokens = [[*WORD.findall(fold(t)), ""] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    counts = Counter(w for own, out in zip(tokens, held, strict=True) if not out for w in own)
    total = sum(counts.values())
    mass = total + 0.5 * (len(counts) + 1)
    return [
        (i, out, len(own), sum(counts[w] > 0 for w in own), total, sum(math.log10((counts[w] + 0.5) / mass) for w in own))
        for (i, _), own, out in zip(rows, tokens, held, strict=True)
    ]


def conversations(rows):
    """From (conv_id, turn, role, text) rows; turn order, then role and text."""
    whole = {}
    for conv, turn, role, text in rows:
        whole.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    out = []
    for conv, turns in whole.items():
        turns.sort()
        learned = "".join(t for _, r, t in turns if r == "assistant")
        body = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        out.append((conv, len(turns), sha(body), len(learned), sha(learned)))
    return out
