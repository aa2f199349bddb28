"""Licence scans: a positional index of the templates' rare words, and verified key phrases."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fresh, held, text_of

# The base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


@dataclass(frozen=True)
class Template:
    """A licence notice; ``phrases`` must stand in a text where the template has them."""

    label: str
    notice: str
    phrases: tuple[str, ...]


# Notices of public licences, as their stewards word them.
TEMPLATES = (
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", ("general public license", "version 2")),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("general public license", "version 3")),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "licensed under the mit license", ("mit license",)),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software"
        " and associated documentation files",
        ("permission is hereby granted", "copy of this software"),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted"
        " provided that the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    Template(
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license v 2 0",),
    ),
)

RAW_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Alphanumeric or non-ASCII runs, A-Z lower-cased."""
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), RAW_SEPARATORS), "")


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def idf_order(docs: DataFrame, text: str = "text", templates=TEMPLATES) -> list[str]:
    """The templates' words, rarest in ``docs`` first. Counted over all documents; the driver gets
    one row per template word, of which there are as many as the templates say."""
    vocabulary = sorted({w for t in templates for w in t.notice.split()})
    present = F.array_intersect(_strings(vocabulary), words(text_of(text)))
    counts = docs.select(F.explode(present).alias("word")).groupBy("word").count()
    seen = {r["word"]: r["count"] for r in counts.collect()}
    return sorted(vocabulary, key=lambda w: (seen.get(w, 0), w))


def _equal_at(w: Column, start: Column, phrase: list[str]) -> Column:
    out = F.lit(True)
    for j, word in enumerate(phrase):
        out = out & F.coalesce(F.get(w, start + j) == word, F.lit(False))
    return out


def _places(w: Column, phrase: str) -> Column:
    first, *rest = phrase.split()
    starts = F.transform(w, lambda x, i: F.when((x == first) & _equal_at(w, i + 1, rest), i))
    return F.array_compact(starts)


def scan(
    docs: DataFrame, text: str = "text", templates=TEMPLATES, rare_words: int = 4, into: str = "licence"
) -> DataFrame:
    """``docs`` with a struct ``licence``: n_words, n_base, first_word, last_word,
    base_labels, matches, labels, score.

    Base: places where a phrase's words stand consecutively. Method: of each template the
    ``rare_words`` words that are rarest in the corpus make up an index of (word, template,
    position); a text's occurrences of such words vote for (template, text position - template
    position); where two different words agree, the template is laid on the text and counts if its
    mandatory phrases stand there word by word. ``matches``: (label, start, share of the template's
    words that agree). score: the best share, at least 0.5 where a base phrase stands, else 0.
    Null or empty text: no words, no labels, score 0. Built-in functions only.
    """
    order = idf_order(docs, text, templates)
    rank = {word: k for k, word in enumerate(order)}
    postings = []
    for number, template in enumerate(templates):
        own = template.notice.split()
        rarest = sorted(set(own), key=rank.get)[:rare_words]
        postings += [(word, number, k) for k, word in enumerate(own) if word in rarest]
    index_words = [w for w in order if any(p[0] == w for p in postings)]
    keys = list(dict.fromkeys([*index_words, *(p.split()[0] for p in PHRASES)]))
    w_name, present_name, places_name, votes_name, m_name = fresh(
        docs, "lic_words", "lic_present", "lic_places", "lic_votes", "lic_matches"
    )
    w, present = F.col(w_name), F.col(present_name)
    out = docs.withColumn(w_name, words(text_of(text)))
    out = out.withColumn(present_name, F.array_intersect(_strings(keys), w))
    found = []
    for phrase, label in PHRASES.items():
        places, none = _places(w, phrase), F.array().cast("array<int>")
        found.append(F.when(F.array_contains(present, phrase.split()[0]), places).otherwise(none).alias(label))
    out = out.withColumn(places_name, F.struct(*found))
    # Of the file's own index words; most files have none, and go no further.
    own = F.array_intersect(_strings(index_words), present)
    by_word = F.create_map(
        *[
            x
            for word in index_words
            for x in (
                F.lit(word),
                F.array(*[F.struct(F.lit(t).alias("t"), F.lit(k).alias("k")) for v, t, k in postings if v == word]),
            )
        ]
    )
    hits = F.filter(F.transform(w, _with_place), lambda h: F.array_contains(own, h["w"]))
    votes = F.flatten(F.transform(hits, lambda h: _votes(by_word, h)))
    votes = F.when(F.size(own) >= 2, F.array_sort(F.array_distinct(votes)))
    out = out.withColumn(votes_name, votes)
    v = F.col(votes_name)
    # Sorted by (template, offset, word), so that a second word for an offset follows the first.
    agreed = F.array_distinct(
        F.transform(F.filter(v, lambda x, j: _same_cell(x, F.get(v, j - 1))), lambda x: F.struct(x["t"], x["o"]))
    )
    out = out.withColumn(votes_name, agreed)
    out = out.withColumn(m_name, F.filter(F.transform(F.col(votes_name), _matcher(w, templates)), lambda m: m["ok"]))
    return _summed_up(out, docs, w_name, present_name, places_name, votes_name, m_name, into)


def _with_place(word: Column, i: Column) -> Column:
    return F.struct(word.alias("w"), i.alias("i"))


def _votes(by_word: Column, hit: Column) -> Column:
    return F.transform(
        F.element_at(by_word, hit["w"]),
        lambda p: F.struct(p["t"].alias("t"), (hit["i"] - p["k"]).alias("o"), hit["w"].alias("w")),
    )


def _same_cell(x: Column, before: Column) -> Column:
    return F.coalesce((x["t"] == before["t"]) & (x["o"] == before["o"]), F.lit(False))


def _matcher(w: Column, templates):
    def match(cell: Column) -> Column:
        label, share, ok = (F.when(F.lit(False), F.lit(x)) for x in ("", 0.0, False))
        for number, template in enumerate(templates):
            own = template.notice.split()
            here = cell["t"] == number
            agree = sum((F.coalesce(F.get(w, cell["o"] + k) == word, F.lit(False)).cast("int") for k, word in enumerate(own)), F.lit(0))
            fits = F.lit(True)
            for phrase in template.phrases:
                parts = phrase.split()
                at = next(k for k in range(len(own)) if own[k : k + len(parts)] == parts)
                fits = fits & _equal_at(w, cell["o"] + at, parts)
            label, share, ok = label.when(here, F.lit(template.label)), share.when(here, agree / len(own)), ok.when(here, fits)
        return F.struct(label.alias("label"), cell["o"].alias("start"), share.alias("share"), ok.alias("ok"))

    return match


def _summed_up(out: DataFrame, docs: DataFrame, w, present, places, votes, matches, into: str) -> DataFrame:
    p = F.col(places)
    starts = F.array_sort(F.concat(*[p[label] for label in PHRASES.values()]))
    base = F.array_sort(F.array_compact(F.array(*[F.when(F.size(p[label]) > 0, F.lit(label)) for label in PHRASES.values()])))
    found = F.coalesce(F.col(matches), F.array().cast("array<struct<label:string,start:int,share:double,ok:boolean>>"))
    labels = F.array_sort(F.array_union(base, F.transform(found, lambda m: m["label"])))
    best = F.greatest(
        F.coalesce(F.array_max(F.transform(found, lambda m: m["share"])), F.lit(0.0)),
        F.when(F.size(base) > 0, F.lit(0.5)).otherwise(0.0),
    )
    (name,) = fresh(docs, into)
    result = F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        base.alias("base_labels"),
        F.transform(found, lambda m: m.dropFields("ok")).alias("matches"),
        labels.alias("labels"),
        best.cast("double").alias("score"),
    )
    return held(out, name, result).drop(w, present, places, votes, matches)
