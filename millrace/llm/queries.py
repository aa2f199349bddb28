"""The operators as queries over the test tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, chat, decontam, licences, logbilinear, mixing, quality, ranked, simhash, suffix, turntrie, units, warc
from millrace.llm.common import cut_bytes, table, text_of

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    m = F.col("metrics")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return quality.judged(docs).select(
        "doc_id", *[m[c].cast("long").alias(c) for c in counts], "base_failed", "kept", F.array_join("failed_rules", ";").alias("failed_rules")
    )


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    records = warc.warc_records(pages, warc.archives_for(pages))
    replica = warc.damaged_copy(records)
    found = warc.audit(warc.record_hashes(records), warc.record_hashes(replica))
    return found.select("archive", "offset", "original_id", "replica_id", "original_digest", "replica_digest", "status")


# Another layout than the table's rows, to be found by its fingerprint.
ODD_TEXT = "\\### Assistant: </turn> ok"


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    records = rows.select("conv_id", F.to_variant_object(F.struct("role", "text", "turn")).alias("record"))
    odd = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.to_variant_object(F.struct(F.lit(ODD_TEXT).alias("prompt"), F.lit(ODD_TEXT).alias("response"))).alias("record"),
    )
    back = chat.read_back(chat.format_turns(chat.canonical_turns(records.unionByName(odd))))
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join("learned", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = F.col("licence")
    return licences.scan(docs).select(
        "doc_id",
        *[found[c].alias(c) for c in ("n_words", "n_base", "first_word", "last_word")],
        F.array_join(found["base_labels"], ",").alias("base_labels"),
        F.array_join(found["labels"], ",").alias("labels"),
        found["score"].alias("score"),
    )


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = suffix.mark_repeats(docs)
    kept = F.when(F.size("repeats") == 0, text_of("text").cast("binary")).otherwise(cut_bytes(text_of("text"), F.col("repeats")))
    return marked.select(
        "doc_id",
        F.octet_length(text_of("text")).cast("long").alias("n_bytes"),
        F.aggregate("repeats", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
        F.size("repeats").cast("long").alias("n_spans"),
        F.sha2(kept, 256).alias("kept_sha256"),
    )


def op7_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logbilinear.score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op9_unit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = units.dedup_units(docs)
    return out.select(
        "doc_id",
        F.octet_length(text_of("text")).cast("long").alias("n_bytes"),
        F.size("removed").cast("long").alias("n_units_removed"),
        F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
        F.array_join(F.transform("removed", lambda s: F.concat_ws("-", s["start"], s["end"])), ",").alias("removed_spans"),
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    benchmark = table(spark, sf_dir, "benchmark").select("item_id", "text")
    found = docs.select("doc_id", decontam.find_contamination(docs, benchmark).alias("f"))
    return found.select(
        "doc_id",
        "f.n_words",
        "f.n_hit",
        F.size("f.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("f.items", ","), 256).alias("items_sha256"),
        (F.col("f.n_hit") > 0).alias("contaminated"),
    )


def op11_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return turntrie.prefix_trie(turntrie.rebuilt(turntrie.conversation_paths(rows))).drop("turn_id")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    benchmark = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return ranked.search(docs, benchmark)


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_byte_bpe,
        op3_warc_fixity,
        op4_chat_format,
        op5_licence_scan,
        op6_suffix_dedup,
        op7_log_bilinear,
        op8_simhash,
        op9_unit_dedup,
        op10_decontaminate,
        op11_turn_trie,
        op12_ranked_search,
        op13_source_mix,
    )
}
