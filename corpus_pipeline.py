"""Corpus pipeline: rules, near-duplicates, repeated passages, benchmark passages, tokenizer round trip."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, decontam, nearcopies, quality, suffix
from millrace.llm.common import table, written


# Passages of some fifty words and more are cut where they repeat.
PASSAGE_BYTES = 240


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule table accepts; others go."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (similarity of five-word shingles 0.8 or more) the document with the smallest id."""
    return nearcopies.drop_near_copies(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of PASSAGE_BYTES or more that start twice are cut from every text; n_chars follows."""
    return _counted(suffix.cut_repeats(docs, length=PASSAGE_BYTES))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut; documents that are benchmark for the most part go."""
    return _counted(decontam.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents with their token ids; the text is what the ids decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encode(docs, path, public_tokenizers.PATTERN)
    return coded.withColumn("text", F.col("decoded").cast("string")).drop("decoded")


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("tokenize", tokenize),
]

# Suffix sorting, SimHash links and token merges are beyond SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
