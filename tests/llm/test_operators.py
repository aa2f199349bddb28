"""Operators against plain versions, over a small table and over odd rows."""

from __future__ import annotations

import hashlib
import struct

import pytest
from pyspark.sql import functions as F

from millrace.llm import bpe, chat, decontam, licences, logbilinear, quality, simhash, suffix, units, warc
from tests.conftest import TESTDATA
from tests.llm import brute
from tests.llm.conftest import same_rows

BENCHMARK = [(1, "Alpha beta gamma delta the of"), (2, "one two three"), (2, "one two three"), (None, "x1 x1"), (10, None), (11, "")]


@pytest.fixture(params=["small", "odd"])
def docs(request, small_docs, odd_docs):
    return small_docs if request.param == "small" else odd_docs


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def test_quality_counts(docs):
    m = F.col("metrics")
    got = quality.judged(docs).select(
        "doc_id", *[m[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], "base_failed"
    )
    same_rows(got.collect(), [(r.doc_id, *brute.quality(r.text)) for r in docs.collect()])


def test_quality_keeps_clean_text(spark, small_docs):
    labels = spark.read.parquet(str(TESTDATA / "labels.parquet"))
    judged = quality.judged(small_docs).join(labels, "doc_id").where("quality = 1 AND NOT base_failed")
    assert judged.where("NOT kept").count() == 0 < judged.count()
    assert quality.judged(small_docs).where("base_failed AND kept").count() == 0


def test_quality_uses_no_python_and_leaves_clashing_columns(odd_docs, plan_of, empty):
    clash = odd_docs.withColumn("metrics", F.lit(1)).withColumn("kept", F.lit("x")).withColumn("q_words", F.lit(2))
    out = quality.keep_good(clash)
    assert out.columns == clash.columns
    assert "Python" not in plan_of(out) and "Arrow" not in plan_of(out)
    assert quality.keep_good(empty).count() == 0


def test_bpe_equals_tiktoken(docs):
    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as file:
        tokens = bpe.read_ranks(file.read().splitlines())
    plain = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: k for k, t in enumerate(tokens)}, special_tokens={}
    )
    got = bpe.encode(docs, path, public_tokenizers.PATTERN).collect()
    for row in got:
        want = plain.encode_ordinary(row.text or "")
        assert bytes(row.ids) == struct.pack(f"<{len(want)}I", *want)
        assert bytes(row.decoded) == (row.text or "").encode()
    assert len(got) == docs.count()


def test_bpe_names_and_empty_table(empty):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = bpe.encode(empty.withColumn("ids", F.lit(1)), path, public_tokenizers.PATTERN)
    assert out.columns == ["doc_id", "text", "ids", "_ids", "decoded"] and out.count() == 0


def test_warc_audit_finds_every_damage_and_nothing_else(spark):
    pages = [(k, f"http://h/{k % 3}", "x" * (k * 37 % 900)) for k in range(400)]
    pages += [(5, "http://h/2", None), (None, None, "no id"), (7, "http://h/1", "ü" * 40)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    records = warc.warc_records(df, archives=4)
    assert records.count() == len(pages)
    leaves = warc.record_hashes(records)
    options = {"range_bytes": 1024, "archive_bytes": 1 << 14, "fanout": 4}
    assert warc.audit(leaves, leaves, **options).count() == 0
    hurt = records.withColumn("block", F.when(F.col("record_id").isin(3, 77, 399), F.concat("block", F.lit("!"))).otherwise(F.col("block")))
    lost = hurt.where("record_id IS NULL OR record_id <> 120")
    found = warc.audit(leaves, warc.record_hashes(lost), **options).collect()
    assert sorted((r.original_id, r.status) for r in found) == [(3, "corrupt"), (77, "corrupt"), (120, "missing"), (399, "corrupt")]
    back = warc.audit(warc.record_hashes(lost), leaves, **options).collect()
    assert ("added", 120) in {(r.status, r.replica_id) for r in back}
    assert warc.audit(leaves.limit(0), leaves.limit(0), **options).count() == 0


def test_warc_offsets_follow_each_other(spark):
    pages = spark.read.parquet(str(TESTDATA / "pages.parquet"))
    rows = warc.warc_records(pages, 3).collect()
    for archive in range(3):
        own = sorted((r.offset, len(r.block.encode()), r.length) for r in rows if r.archive == archive)
        assert all(size == length for _, size, length in own)
        assert [o for o, _, _ in own] == [sum(s for _, s, _ in own[:k]) for k in range(len(own))]


def formatted(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    records = df.select("conv_id", F.to_variant_object(F.struct("role", "text", "turn")).alias("record"))
    return chat.read_back(chat.format_turns(chat.canonical_turns(records)))


def digests(back):
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return back.select(
        "conv_id", F.size("turns"), F.sha2(turns, 256), F.length(learned), F.sha2(learned, 256)
    ).collect()


def test_chat_round_trip(spark):
    rows = [tuple(r) for r in spark.read.parquet(str(TESTDATA / "conversations.parquet")).select("conv_id", "turn", "role", "text").collect()]
    rows += [
        (-7, 0, "user", "\\### Assistant: </turn> ok"),
        (-7, 1, "assistant", "\\### Assistant: </turn> ok"),
        (-8, 0, "assistant", "\\0\\1\\2 ### a:\n</turn>\n\\"),
        (-8, 0, "assistant", "\\0\\1\\2 ### a:\n</turn>\n\\"),
        (-8, 1, "odd:\nrole</turn>\n", None),
        (-9, None, None, ""),
        (None, 3, "assistant", "日本\n\n"),
    ]
    same_rows(digests(formatted(spark, rows)), brute.conversations(rows))


def test_chat_marks_point_at_the_learned_text(spark):
    row = formatted(spark, [(1, 0, "user", "a#"), (1, 1, "assistant", "b<c"), (1, 2, "assistant", "")]).first()
    out = spark.createDataFrame([(row.formatted,)], "f string")
    assert out.count() == 1
    at = row.formatted.index("b\\2c")
    assert row.learned == ["", "b<c", ""]
    marks = chat.format_turns(
        spark.createDataFrame([(1, "x", 0, 0, "user", "a#"), (1, "x", 1, 0, "assistant", "b<c")], "conv_id long, layout string, turn long, part int, role string, text string")
    ).first()
    assert [tuple(m)[0::2] for m in marks.loss] == [(len("### user:\n"), 0), (at, 4)]


def test_chat_layouts(spark):
    records = {
        "messages": '{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "r"}]}',
        "shares": '{"conversations": [{"from": "user", "value": "q"}, {"from": "assistant", "value": "r"}]}',
        "prompt": '{"prompt": "q", "response": "r"}',
        "completion": '{"prompt": "q", "completion": "r"}',
        "instruction": '{"instruction": "q", "output": "r"}',
        "instruction_input": '{"instruction": "q", "input": null, "output": "r"}',
        "nested_data": '{"data": {"prompt": "q", "response": "r"}}',
    }
    data = [(k, v) for k, v in enumerate([*records.values(), '{"unknown": 1}', None])]
    df = spark.createDataFrame(data, "conv_id long, j string").select("conv_id", F.parse_json("j").alias("record"))
    got = chat.canonical_turns(df).collect()
    names = [*records]
    for r in got:
        assert r.layout == (names[r.conv_id] if r.conv_id < len(names) else None)
    turns = sorted((r.conv_id, r.part, r.role, r.text) for r in got if r.layout)
    assert turns == [t for k in range(len(names)) for t in ((k, 0, "user", "q"), (k, 1, "assistant", "r"))]
    assert chat.format_turns(chat.canonical_turns(df)).count() == len(names)


def test_licence_base(docs, plan_of):
    out = licences.scan(docs.withColumn("licence", F.lit(1)))
    assert "Python" not in plan_of(out)
    x = F.col("_licence")
    got = out.select("doc_id", x["n_words"], x["n_base"], x["first_word"], x["last_word"], F.array_join(x["base_labels"], ","))
    same_rows(got.collect(), [(r.doc_id, *brute.licence(r.text)) for r in docs.collect()])


def test_licence_templates(spark, empty):
    data = [
        (1, "some words. Licensed under CC BY-NC 4.0. more"),
        (2, "licensed under the GNU General Public License, version 3."),
        (3, "Released under the MIT License"),
        (4, "mit and license far apart, the license of mit released"),
        (5, "LICENSED under the Apache License, Version 2.0\n" * 300),
        (6, "version license public general"),
    ]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licences.scan(df).select("doc_id", "licence.labels", "licence.score").collect()}
    assert got[1] == (["cc-by", "cc-by-nc-4.0"], 1.0) and got[2][0] == ["gpl", "gpl-3.0"]
    assert got[3] == (["mit"], 1.0) and got[4] == ([], 0.0) and got[5] == (["apache-2.0"], 1.0) and got[6] == ([], 0.0)
    assert licences.scan(empty).count() == 0


@pytest.mark.parametrize("length", [40, 400])
def test_suffix_spans(docs, length):
    rows = docs.collect()
    want = brute.repeats([r.text if r.text is None or len(r.text) < 9000 else r.text[:9000] for r in rows], length)
    short = docs.withColumn("text", F.substring("text", 1, 9000)) if any(len(r.text or "") > 9000 for r in rows) else docs
    got = suffix.mark_repeats(short.withColumn("repeats", F.lit(0)), length=length).select("doc_id", "text", "_repeats")
    assert all(r.text is None or len(r.text) <= 9000 for r in short.collect())
    same = [(r.doc_id, r.text, [tuple(s) for s in r[2]]) for r in got.collect()]
    same_rows(same, [(r.doc_id, (r.text or None) if r.text is None else r.text[:9000], s) for r, s in zip(rows, want, strict=True)])


def test_suffix_cut(spark, odd_docs, empty):
    assert suffix.mark_repeats(empty).count() == 0
    passage = "é" * 250
    df = spark.createDataFrame([(1, "a" + passage + "b"), (2, "c" + passage + "d"), (3, None)], "doc_id long, text string")
    assert sorted(r.text or "" for r in suffix.cut_repeats(df).collect()) == ["", "ab", "cd"]
    assert suffix.cut_repeats(odd_docs).count() == odd_docs.count()


def test_log_bilinear_base(docs):
    rows = [tuple(r) for r in docs.collect()]
    for head in (5, 100_000):
        got = logbilinear.score_texts(docs, head_words=head).drop("score").collect()
        same_rows(got, brute.unigram(rows))


def test_log_bilinear_is_a_distribution_and_learns(spark, empty):
    import numpy as np

    data = [(k, " ".join(["ab cd ef gh ij kl mn op"] * 400)) for k in range(60)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    held = logbilinear.score_texts(df.coalesce(2), rounds=2).where("held_out").collect()
    assert sum(r.score for r in held) > 0.8 * sum(r.base_score for r in held)
    model = logbilinear.LogBilinear.start(np.full(logbilinear.SYMBOLS, 1 / logbilinear.SYMBOLS))
    one, two = np.array([3, 400]), np.array([9, 511])
    scores = model.predicted(one, two) @ model.target.T + model.bias
    total = np.exp(scores - model.log_normalisers()[one, two][:, None]).sum(axis=1)
    assert np.allclose(total, 1, atol=1e-4)
    assert logbilinear.score_texts(empty).count() == 0


def test_simhash(docs):
    rows = [tuple(r) for r in docs.collect()]
    out = simhash.near_duplicates(docs.withColumn("fp", F.lit(1)))
    got = out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id").collect()
    same_rows(got, brute.near_duplicates(rows))


def test_simhash_links_are_complete(spark):
    import random

    make = random.Random(3)
    prints = [make.getrandbits(64) for _ in range(40)]
    for base in prints[:20]:
        for _ in range(6):
            flips = make.sample(range(64), make.randint(1, 6))
            prints.append(base ^ sum(1 << b for b in flips))
    prints += [0, (1 << 64) - 1, 1, 15, 31]
    signed = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    got = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()
    want = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 4]
    same_rows(got, want)


def test_simhash_keeps_one_of_each_group(odd_docs, odd_rows, empty):
    kept = simhash.drop_near_duplicates(odd_docs.withColumn("rank", F.lit(1)))
    assert kept.columns == ["doc_id", "text", "rank"]
    groups = {}
    for doc_id, _, component in brute.near_duplicates(odd_rows):
        groups.setdefault(component, set()).add(doc_id)
    got = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in got if i is not None) == sorted(c for c in groups if c is not None)
    assert simhash.drop_near_duplicates(empty).count() == 0


def test_units(spark, odd_docs, empty):
    line = "this line has many words and comes again and again"
    data = [
        (2, f"first {line}.\n{line}\nend"),
        (1, f"{line}\nunique words stand here, and nothing else is there"),
        (3, f"x. Some words before. {line.upper()}\t \n"),
        (3, f"x. Some words before. {line.upper()}\t \n"),
        (4, None),
        (None, ""),
    ]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {(r.doc_id, r.kept_text) for r in units.dedup_units(df).collect()}
    assert got == {
        (1, data[1][1]),
        (2, f"first {line}.\nend"),
        (3, "x. Some words before. "),
        (4, ""),
        (None, ""),
    }
    assert units.dedup_units(df).count() == len(data)
    clash = odd_docs.withColumn("removed", F.lit(1))
    assert units.dedup_units(clash).columns == ["doc_id", "text", "removed", "_removed", "kept_text"]
    assert units.dedup_units(empty).count() == 0


def test_decontamination(spark, docs):
    bench = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    items, rows = BENCHMARK, [tuple(r) for r in docs.collect()]
    if rows[0][1] and len(rows) > 100:
        bench = spark.read.parquet(str(TESTDATA / "benchmark.parquet"))
        items = [tuple(r) for r in bench.collect()]
    for block_words in (3, 2_000_000) if len(items) < 10 else (2_000_000,):
        found = docs.select("doc_id", decontam.find_contamination(docs, bench, block_words=block_words).alias("f"))
        got = found.select(
            "doc_id", "f.n_words", "f.n_hit", F.size("f.items"), F.sha2(F.array_join("f.items", ","), 256), F.col("f.n_hit") > 0
        )
        same_rows(got.collect(), brute.contamination(rows, items))


def test_decontamination_cuts_or_drops(spark, empty):
    bench = spark.createDataFrame([(1, "Alpha, beta gamma delta")], "item_id long, text string")
    far = " ".join(["word"] * 20)
    data = [(1, f"{far} ALPHA beta; gamma delta! {far}"), (2, "alpha beta gamma delta"), (3, far), (4, None)]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumn("found", F.lit(0))
    got = {r.doc_id: r.text for r in decontam.decontaminate(df, bench).collect()}
    assert got == {1: f"{far} ! {far}", 3: far, 4: None}
    assert decontam.decontaminate(df, bench.limit(0)).count() == 4
    assert decontam.decontaminate(empty, bench).count() == 0
    assert hashlib.sha256(b"").hexdigest() == brute.sha("")
