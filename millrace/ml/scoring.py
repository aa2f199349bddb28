"""Incremental scoring: candidate orders, imputation, alerts."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.ml.expression import Weights
from millrace.plans.features import FEATURES, scoring_features

# Fixed value: an order is alerted below this probability of a good rating.
ALERT_THRESHOLD = 0.55

ALERT_DDL = (
    "order_id string, purchase_time_key int, score double, "
    "predicted_label int, scored_at timestamp_ntz"
)


def _newest(df: DataFrame) -> int | None:
    return df.agg(F.max("purchase_time_key")).first()[0]


def candidate_lines(fact_sales: DataFrame, alerts: DataFrame | None) -> DataFrame:
    """Sales lines of the orders to score.

    Without an alert table: the latest purchase day. With one: days after the
    newest alerted order, minus orders alerted already. All lines of an order
    share its purchase day, so lines are selected before they are aggregated and
    the single boundary value becomes a filter of the scan.
    """
    day = F.col("purchase_time_key")
    if alerts is None:
        newest = _newest(fact_sales)
        return fact_sales if newest is None else fact_sales.where(day == newest)
    newest = _newest(alerts)
    fresh = fact_sales if newest is None else fact_sales.where(day > newest)
    return fresh.join(alerts.select("order_id").distinct(), "order_id", "left_anti")


def scoring_candidates(fact_sales: DataFrame, alerts: DataFrame | None) -> DataFrame:
    return scoring_features(candidate_lines(fact_sales, alerts))


def feature_means(features: DataFrame) -> DataFrame:
    """One row: the mean of every feature."""
    return features.agg(*[F.avg(c).alias(c) for c in FEATURES])


def impute_means(features: DataFrame, training: DataFrame) -> DataFrame:
    """Fill NULL features with the training means, or 0 where there is none."""
    means = feature_means(training).first().asDict()
    return features.select(
        *[
            F.coalesce(F.col(c).cast("double"), F.lit(float(means[c] or 0.0))).alias(c)
            if c in FEATURES
            else F.col(c)
            for c in features.columns
        ]
    )


def alerts_for(
    candidates: DataFrame,
    model: PipelineModel | Weights,
    scored_at: str,
    threshold: float = ALERT_THRESHOLD,
) -> DataFrame:
    """Rows to append to the alert table. The model is applied as one expression."""
    weights = model if isinstance(model, Weights) else Weights.of(model)
    return (
        weights.predict(candidates)
        .where(F.col("score") < threshold)
        .select(
            "order_id",
            "purchase_time_key",
            F.col("score").cast("double").alias("score"),
            F.lit(0).alias("predicted_label"),
            F.lit(scored_at).cast("timestamp_ntz").alias("scored_at"),
        )
    )


def score_new_orders(
    fact_sales: DataFrame,
    training: DataFrame,
    model: PipelineModel | Weights,
    alerts: DataFrame | None,
    scored_at: str,
    threshold: float = ALERT_THRESHOLD,
) -> DataFrame:
    candidates = impute_means(scoring_candidates(fact_sales, alerts), training)
    return alerts_for(candidates, model, scored_at, threshold)
