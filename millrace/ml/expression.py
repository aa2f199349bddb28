"""A fitted logistic pipeline as plain numbers, and its score as one column expression.

The expression needs no vectors and no Python: it stays inside code generation, can be
pushed around by the optimizer like any other, and can be written down in SQL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import StandardScalerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WEIGHTS_DDL = "place int, feature string, mean double, deviation double, coefficient double"
INTERCEPT = "(intercept)"


@dataclass(frozen=True)
class Weights:
    """Per feature its mean, deviation and coefficient on the standardised value; and the intercept."""

    features: tuple[str, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]
    coefficients: tuple[float, ...]
    intercept: float

    @classmethod
    def of(cls, model: PipelineModel) -> Weights:
        """From a pipeline of assembler, standard scaler and binary logistic regression."""
        assembler, scaler, regression = model.stages
        kinds = (VectorAssembler, StandardScalerModel, LogisticRegressionModel)
        if not all(isinstance(s, k) for s, k in zip(model.stages, kinds, strict=True)):
            raise TypeError(f"not a pipeline of assembler, scaler and regression: {model.stages}")
        features = tuple(assembler.getInputCols())
        none, one = (0.0,) * len(features), (1.0,) * len(features)
        return cls(
            features,
            tuple(map(float, scaler.mean)) if scaler.getWithMean() else none,
            tuple(map(float, scaler.std)) if scaler.getWithStd() else one,
            tuple(map(float, regression.coefficients)),
            float(regression.intercept),
        )

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Weights:
        """As saved by ``save``: one row per feature, so the driver sees no more than the model."""
        rows = {r.place: r for r in spark.read.schema(WEIGHTS_DDL).parquet(path).collect()}
        inputs = [rows[k] for k in sorted(rows) if k >= 0]
        return cls(
            tuple(r.feature for r in inputs),
            tuple(r["mean"] for r in inputs),
            tuple(r.deviation for r in inputs),
            tuple(r.coefficient for r in inputs),
            rows[-1].coefficient,
        )

    def rows(self, spark: SparkSession) -> DataFrame:
        """The model as a table; the intercept has place -1."""
        columns = zip(self.features, self.means, self.deviations, self.coefficients, strict=True)
        inputs = [(k, *values) for k, values in enumerate(columns)]
        return spark.createDataFrame([*inputs, (-1, INTERCEPT, 0.0, 1.0, self.intercept)], WEIGHTS_DDL)

    def save(self, spark: SparkSession, path: str) -> None:
        self.rows(spark).coalesce(1).write.mode("overwrite").parquet(path)

    def margin(self) -> Column:
        """Log-odds of class 1. A feature without spread adds nothing, as in the scaler."""
        out = F.lit(self.intercept)
        for name, mean, deviation, weight in zip(
            self.features, self.means, self.deviations, self.coefficients, strict=True
        ):
            if deviation:
                out = out + (F.col(name).cast("double") - F.lit(mean)) / F.lit(deviation) * F.lit(weight)
        return out

    def score(self) -> Column:
        """Probability of class 1; NULL where a feature is."""
        return 1.0 / (1.0 + F.exp(-self.margin()))

    def complete(self) -> Column:
        """Whether a row has all features; the pipeline's assembler leaves the others out."""
        out = F.lit(True)
        for name in self.features:
            out = out & F.col(name).isNotNull() & ~F.isnan(F.col(name).cast("double"))
        return out

    def predict(self, rows: DataFrame) -> DataFrame:
        """``rows`` that have all features, with ``score`` and ``prediction`` (1.0 from one half on)."""
        scored = rows.where(self.complete()).withColumn("score", self.score())
        return scored.withColumn("prediction", F.when(F.col("score") > 0.5, 1.0).otherwise(0.0))
