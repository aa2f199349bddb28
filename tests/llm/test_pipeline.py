"""The pipeline's stages, each against a plain version on what the stage before it kept."""

from __future__ import annotations

import struct

import corpus_pipeline
from millrace.llm import quality
from millrace.llm.common import table, written
from tests.conftest import TESTDATA
from tests.llm import brute
from tests.llm.test_nearcopies import keepers


def fixed(spans, raw):
    out, at = b"", 0
    for a, b in spans:
        out += raw[at:a]
        at = b
    return (out + raw[at:]).decode("utf-8", "ignore")


def test_stages(spark):
    import public_tokenizers
    import tiktoken

    from millrace.llm import bpe

    folder = str(TESTDATA)
    docs = table(spark, folder, "documents")
    outputs = []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, folder), name)
        outputs.append({r.doc_id: r for r in docs.collect()})
    columns = table(spark, folder, "documents").columns
    source = {r.doc_id: r for r in table(spark, folder, "documents").collect()}
    rules, unique, cut, clean, coded = outputs
    assert all(set(r.asDict()) == set(columns) for out in outputs[:4] for r in out.values())

    judged = {r.doc_id: r.kept for r in quality.judged(table(spark, folder, "documents")).collect()}
    assert set(rules) == {i for i, kept in judged.items() if kept}
    assert all(rules[i] == source[i] for i in rules)

    # Near copies have five-word shingle sets of similarity 0.8 or more; all pairs are compared.
    pairs = [(i, r.text) for i, r in rules.items()]
    assert set(unique) == {i for _, i in keepers(pairs)} and len(unique) < len(rules)

    ids = list(unique)
    spans = brute.repeats([unique[i].text for i in ids], corpus_pipeline.PASSAGE_BYTES)
    assert set(cut) == set(ids)
    for i, own in zip(ids, spans, strict=True):
        assert cut[i].text == fixed(own, unique[i].text.encode()) and cut[i].n_chars == len(cut[i].text)

    items = [tuple(r) for r in table(spark, folder, "benchmark").select("item_id", "text").collect()]
    found = {r[0]: r for r in brute.contamination([(i, r.text) for i, r in cut.items()], items)}
    assert set(clean) == {i for i, r in found.items() if r[2] == 0 or 2 * r[2] < r[1]}
    assert all(clean[i].text == cut[i].text for i in clean if not found[i][5])
    assert all(len(clean[i].text) < len(cut[i].text) for i in clean if found[i][5])

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        tokens = bpe.read_ranks(file.read().splitlines())
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: k for k, t in enumerate(tokens)}, special_tokens={})
    for i, r in coded.items():
        want = plain.encode_ordinary(clean[i].text)
        assert bytes(r.ids) == struct.pack(f"<{len(want)}I", *want) and r.text == clean[i].text
    assert len(coded) == len(clean) > 0


def test_run_and_empty_table(spark):
    last = corpus_pipeline.run(spark, str(TESTDATA))
    assert last.count() > 0
    none = table(spark, str(TESTDATA), "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        none = written(stage(spark, none, str(TESTDATA)), name)
        assert none.count() == 0
