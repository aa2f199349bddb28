"""Training: class weights, split, pipeline."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import ratio
from millrace.ml import evaluation
from millrace.plans.features import FEATURES

# Share of the test part, seed, iteration limit.
TEST_SIZE = 0.2
SEED = 42
MAX_ITERATIONS = 1000

WEIGHT = "classWeight"


def complete_rows(features: DataFrame, label: str = "label") -> DataFrame:
    return features.na.drop(subset=[*FEATURES, label])


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Per class: rows, and the balanced weight ``total / (classes * rows)``."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    return (
        counts.agg(
            F.collect_list(F.struct(label, "rows")).alias("classes"),
            F.sum("rows").alias("total"),
            F.count(F.lit(1)).alias("n"),
        )
        .select(F.explode("classes").alias("c"), "total", "n")
        .select(
            F.col(f"c.{label}"),
            F.col("c.rows"),
            ratio(F.col("total"), F.col("n") * F.col("c.rows")).alias(WEIGHT),
        )
    )


def with_class_weight(df: DataFrame, label: str = "label") -> DataFrame:
    """Add the balanced weight of each row's class.

    The weights are one aggregated value (a map with an entry per class) that
    Spark evaluates once as a scalar subquery; the data is not joined or shuffled.
    """
    weights = class_weights(df, label).agg(
        F.map_from_entries(F.collect_list(F.struct(label, WEIGHT))).alias("weights")
    )
    return df.select("*", weights.scalar()[F.col(label)].alias(WEIGHT))


def is_test_row(key: str = "order_id", test_size: float = TEST_SIZE, seed: int = SEED):
    """Membership of the test part, by a hash of the key.

    Within each class the share is ``test_size`` in expectation, as with random
    sampling, but a row's part depends on nothing else: a retried task or
    another partitioning cannot move it, and one order is never in both parts.
    """
    bar = int((1.0 - test_size) * 16**8)
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") >= bar


def split(df: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """Training and test part."""
    test = is_test_row(**options)
    return df.where(~test), df.where(test)


def build_pipeline(label: str = "label", features: tuple[str, ...] = FEATURES) -> Pipeline:
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="raw_features", handleInvalid="skip"),
            StandardScaler(
                inputCol="raw_features", outputCol="features", withMean=True, withStd=True
            ),
            LogisticRegression(
                labelCol=label,
                featuresCol="features",
                weightCol=WEIGHT,
                maxIter=MAX_ITERATIONS,
                regParam=0.0,
                elasticNetParam=0.0,
                standardization=False,
            ),
        ]
    )


def train(features: DataFrame, path: str, **options) -> tuple[PipelineModel, DataFrame]:
    """Fit on the training part and save; returns the saved model and the scored test part.

    The model is used as loaded: a fitted one carries its training summary, which
    holds the session and cannot always be shipped to executors.
    """
    weighted = with_class_weight(complete_rows(features))
    train_part, test_part = split(weighted, **options)
    save_model(build_pipeline().fit(train_part), path)
    model = load_model(path)
    return model, with_score(model.transform(test_part))


def with_score(predictions: DataFrame) -> DataFrame:
    """Add ``score``, the probability of class 1."""
    return predictions.withColumn("score", vector_to_array("probability")[1])


def roc_auc(predictions: DataFrame, label: str = "label") -> float:
    """Exact area under the ROC curve of ``score``; NaN where a class has no rows."""
    area = evaluation.roc_auc(predictions, label).first()["roc_auc"]
    return float("nan") if area is None else area


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
