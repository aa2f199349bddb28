"""Threshold choice and classification report, each from one aggregation over the scores.

Class 0 (a low rating) is the class to detect: its true positives are the rows
of label 0 whose score does not exceed the threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import ratio
from millrace.operators.ranks import running_sums

# Fixed value: the candidate thresholds.
THRESHOLDS = (0.55,)

MODES = ("recall0", "f1")


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row: rows of class 1 and of class 0, and the exact area under the ROC curve.

    The area is the share of pairs of both classes that the score puts in order, ties being half
    in order. Equal scores become one row first, so a hot score is no burden, and the rows before
    each score are summed by ranges. All sums are whole numbers, divided once. Rows without a score or
    with another label are left out; NULL where a class has no rows.
    """
    tied = (
        scored.where(F.col(score).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(F.col(score).alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("good"), F.count_if(F.col(label) == 0).alias("bad"))
    )
    exact = "decimal(38,0)"
    in_order = F.col("good").cast("decimal(19,0)") * (2 * F.col("bad_before") + F.col("bad")).cast("decimal(19,0)")
    sums = running_sums(tied, ["score"], ["bad"]).agg(
        F.sum("good").alias("positives"), F.sum("bad").alias("negatives"), F.sum(in_order.cast(exact)).alias("s")
    )
    pairs = 2 * F.col("positives").cast("decimal(19,0)") * F.col("negatives").cast("decimal(18,0)")
    return sums.select("positives", "negatives", ratio(F.col("s"), pairs).alias("roc_auc"))


def _or_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0.0))


def _counts(threshold: float, label: str, score: str) -> Column:
    low, is0 = F.col(score) <= threshold, F.col(label) == 0
    high, is1 = F.col(score) > threshold, F.col(label) == 1
    return F.struct(
        F.lit(float(threshold)).alias("threshold"),
        F.count_if(low & is0).alias("tp0"),
        F.count_if(low & is1).alias("fp0"),
        F.count_if(high & is0).alias("fn0"),
        F.count_if(high & is1).alias("tp1"),
    )


def confusion_counts(
    scored: DataFrame,
    thresholds: Sequence[float] = THRESHOLDS,
    label: str = "label",
    score: str = "score",
) -> DataFrame:
    """One row of counts per threshold; the scores are read once for all of them."""
    counts = F.array(*[_counts(t, label, score) for t in thresholds])
    return scored.agg(counts.alias("c")).select(F.inline("c"))


def _with_class_measures(counts: DataFrame) -> DataFrame:
    def f1(p: str, r: str) -> Column:
        return _or_zero(ratio(2 * F.col(p) * F.col(r), F.col(p) + F.col(r)))

    def share(hit: str, other: str) -> Column:
        return _or_zero(ratio(F.col(hit), F.col(hit) + F.col(other)))

    return counts.select(
        "*",
        share("tp0", "fp0").alias("precision0"),
        share("tp0", "fn0").alias("recall0"),
        share("tp1", "fn0").alias("precision1"),
        share("tp1", "fp0").alias("recall1"),
    ).select(
        "*", f1("precision0", "recall0").alias("f1_0"), f1("precision1", "recall1").alias("f1_1")
    )


def threshold_scores(
    scored: DataFrame, thresholds: Sequence[float] = THRESHOLDS, **columns: str
) -> DataFrame:
    """Counts and measures of both classes per candidate threshold."""
    measures = _with_class_measures(confusion_counts(scored, thresholds, **columns))
    return measures.withColumn("macro_f1", (F.col("f1_0") + F.col("f1_1")) / 2)


def best_threshold(
    scored: DataFrame,
    thresholds: Sequence[float] = THRESHOLDS,
    mode: str = "recall0",
    **columns: str,
) -> tuple[float, float]:
    """Threshold with the highest class-0 recall or macro F1, and that score; first one on a tie."""
    if mode not in MODES:
        raise ValueError(f"unknown mode: {mode}")
    measure = "recall0" if mode == "recall0" else "macro_f1"
    best = {
        row["threshold"]: row[measure]
        for row in threshold_scores(scored, thresholds, **columns).collect()
    }
    chosen = max(thresholds, key=lambda t: best[float(t)])
    return float(chosen), best[float(chosen)]


def classification_report(scored: DataFrame, threshold: float, **columns: str) -> DataFrame:
    """Precision, recall, F1 and support: per class, macro and weighted average, and accuracy."""
    m = _with_class_measures(confusion_counts(scored, [threshold], **columns)).select(
        "*",
        (F.col("tp0") + F.col("fn0")).alias("n0"),
        (F.col("tp1") + F.col("fp0")).alias("n1"),
    )
    n = F.col("n0") + F.col("n1")

    def macro(a: str, b: str) -> Column:
        return (F.col(a) + F.col(b)) / 2

    def weighted(a: str, b: str) -> Column:
        return _or_zero(ratio(F.col(a) * F.col("n0") + F.col(b) * F.col("n1"), n))

    def line(name: str, p: Column, r: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            p.alias("precision"),
            r.alias("recall"),
            f1.alias("f1_score"),
            support.alias("support"),
        )

    pairs = (("precision0", "precision1"), ("recall0", "recall1"), ("f1_0", "f1_1"))
    nothing = F.lit(None).cast("double")
    accuracy = _or_zero(ratio(F.col("tp0") + F.col("tp1"), n))
    lines = F.array(
        line("0", *[F.col(a) for a, _ in pairs], F.col("n0")),
        line("1", *[F.col(b) for _, b in pairs], F.col("n1")),
        line("accuracy", nothing, nothing, accuracy, n),
        line("macro avg", *[macro(a, b) for a, b in pairs], n),
        line("weighted avg", *[weighted(a, b) for a, b in pairs], n),
    )
    return m.select(F.inline(lines))
