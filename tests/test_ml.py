import pytest
from pyspark.sql import functions as F

from millrace.ml import evaluation, model, scoring
from millrace.ml.expression import Weights
from millrace.plans.features import FEATURES, scoring_features, training_features

SALES = (
    "order_id string, sale_price decimal(12,2), quantity long, freight_value decimal(22,2), "
    "delivery_delay_days int, purchase_time_key int, delivery_time_key int"
)


@pytest.fixture(scope="module")
def sales(spark):
    return spark.sql(
        """SELECT cast(id AS string) AS order_id, cast(id % 50 AS decimal(12,2)) AS sale_price,
        1 + id % 3 AS quantity, cast(id % 7 AS decimal(22,2)) AS freight_value,
        if(id % 10 = 0, NULL, cast(id % 9 - 4 AS int)) AS delivery_delay_days,
        cast(20180100 + 1 + id % 20 AS int) AS purchase_time_key,
        if(id % 10 = 0, NULL, cast(20180125 + id % 5 AS int)) AS delivery_time_key
        FROM range(400)"""
    )


@pytest.fixture(scope="module")
def training(spark, sales):
    reviews = spark.sql(
        "SELECT cast(id AS string) AS Order_id, cast(1 + (id * 7) % 5 AS int) AS Review_score FROM range(400)"
    )
    return training_features(sales, reviews).cache()


def test_features_of_one_order(spark):
    data = [("a", 10, 2, 3, 1, 20180101, 20180110), ("a", 20, 1, 5, 1, 20180101, 20180110)]
    row = scoring_features(spark.createDataFrame([], SALES).unionByName(
        spark.createDataFrame(data, "order_id string, p int, quantity long, f int, delivery_delay_days int, purchase_time_key int, delivery_time_key int")
        .selectExpr("order_id", "cast(p AS decimal(12,2)) AS sale_price", "quantity", "cast(f AS decimal(22,2)) AS freight_value",
                    "delivery_delay_days", "purchase_time_key", "delivery_time_key"))).first()
    assert (row.price_sum, row.price_mean, row.freight_sum, row.freight_mean) == (40.0, 15.0, 8.0, 4.0)
    assert (row.item_count, row.delivery_time, row.freight_ratio) == (3, 9, 0.2)
    assert (row.is_high_freight, row.price_per_item, row.delay_ratio) == (0.0, 40 / 3, 0.1)


def test_zero_price_and_same_day_minus_one_give_null(spark):
    df = spark.sql(
        """SELECT 'a' AS order_id, cast(0 AS decimal(12,2)) AS sale_price, 1L AS quantity,
        cast(1 AS decimal(22,2)) AS freight_value, 1 AS delivery_delay_days,
        20180102 AS purchase_time_key, 20180101 AS delivery_time_key"""
    )
    row = scoring_features(df).first()
    assert row.freight_ratio is None and row.delay_ratio is None and row.is_high_freight is None


def test_weights_are_balanced(spark, training):
    weighted = model.with_class_weight(training)
    sums = {r.label: r.s for r in weighted.groupBy("label").agg(F.sum(model.WEIGHT).alias("s")).collect()}
    assert sums[0] == pytest.approx(sums[1]) == pytest.approx(training.count() / 2)
    only = training.where("label = 0")
    assert model.class_weights(only).first()[model.WEIGHT] == 1.0


def test_split_is_repeatable_and_whole(training):
    train, test = model.split(training)
    again, _ = model.split(training.repartition(7))
    assert train.exceptAll(again).isEmpty() and train.count() == again.count()
    assert train.count() + test.count() == training.count()
    for label in (0, 1):
        share = test.where(F.col("label") == label).count() / training.where(F.col("label") == label).count()
        assert 0.1 < share < 0.3


def test_report_by_hand(spark, rows):
    # Three rows of class 0, of which two are found; one of class 1, which is missed.
    scored = spark.createDataFrame([(0, 0.1), (0, 0.5), (0, 0.9), (1, 0.55)], "label int, score double")
    assert tuple(evaluation.confusion_counts(scored).first()) == (0.55, 2, 1, 1, 0)
    report = {r["class"]: r for r in evaluation.classification_report(scored, 0.55).collect()}
    two_thirds = pytest.approx(2 / 3)
    assert (report["0"].precision, report["0"].recall, report["0"].f1_score) == (two_thirds,) * 3
    assert (report["1"].precision, report["1"].recall, report["1"].f1_score) == (0.0, 0.0, 0.0)
    assert report["accuracy"].f1_score == 0.5 and report["macro avg"].recall == pytest.approx(1 / 3)
    assert report["weighted avg"].recall == 0.5 and report["weighted avg"].support == 4


def test_threshold_choice(spark):
    scored = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.3), (1, 0.9)], "label int, score double")
    assert evaluation.best_threshold(scored, (0.2, 0.5, 0.95)) == (0.5, 1.0)
    assert evaluation.best_threshold(scored, (0.2, 0.5, 0.95), "f1")[0] in (0.2, 0.5)
    with pytest.raises(ValueError):
        evaluation.best_threshold(scored, mode="other")


def test_area_of_pairs_in_order(spark):
    pairs = [(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.1), (0, 0.9), (None, 0.2), (1, None), (1, 0.3)] + [(0, 0.3)] * 50
    df = spark.createDataFrame(pairs, "label int, score double").repartition(5)
    good = [s for label, s in pairs if label == 1 and s is not None]
    bad = [s for label, s in pairs if label == 0 and s is not None]
    want = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / len(good) / len(bad)
    row = evaluation.roc_auc(df).first()
    assert (row.positives, row.negatives, row.roc_auc) == (len(good), len(bad), pytest.approx(want, abs=1e-15))
    assert evaluation.roc_auc(df.where("label = 1")).first().roc_auc is None
    assert evaluation.roc_auc(df.limit(0)).first().roc_auc is None


def test_area_of_many_scores(spark):
    df = spark.range(20_000).selectExpr("cast(id % 3 = 0 AS int) AS label", "cast(hash(id) % 500 AS double) AS score")
    rows = df.toPandas()
    ranks = rows["score"].rank()
    good = rows["label"] == 1
    n = int(good.sum())
    want = (ranks[good].sum() - n * (n + 1) / 2) / (n * (len(rows) - n))
    assert evaluation.roc_auc(df).first().roc_auc == pytest.approx(want, abs=1e-12)


def test_candidates(spark, sales, rows):
    days = sales.agg(F.max("purchase_time_key")).first()[0]
    first = scoring.scoring_candidates(sales, None)
    assert {r.purchase_time_key for r in first.collect()} == {days}
    none = spark.createDataFrame([], scoring.ALERT_DDL)
    assert scoring.scoring_candidates(sales, none).count() == 400
    held = spark.createDataFrame([("19", 20180110)], "order_id string, purchase_time_key int")
    left = scoring.scoring_candidates(sales, held)
    wanted = sales.where("purchase_time_key > 20180110 AND order_id <> '19'")
    assert rows(left, "order_id") == rows(wanted, "order_id")


def test_imputation(spark):
    columns = ", ".join(f"{c} double" for c in FEATURES)
    training = spark.createDataFrame([(1.0,) * 10 + (None,), (3.0,) * 10 + (None,)], columns)
    gaps = spark.createDataFrame([(None,) * 11, (7.0,) * 11], columns)
    assert [tuple(r) for r in scoring.impute_means(gaps, training).collect()] == [
        (2.0,) * 10 + (0.0,),
        (7.0,) * 11,
    ]


def test_train_save_and_score(spark, sales, training, tmp_path):
    fitted, scored = model.train(training, str(tmp_path / "model"))
    assert scored.select("score").where("score IS NULL OR score < 0 OR score > 1").isEmpty()
    assert 0.0 <= model.roc_auc(scored) <= 1.0
    alerts = scoring.score_new_orders(sales, training, fitted, None, "2018-02-01 00:00:00", 1.1)
    assert alerts.count() == 20 and alerts.dtypes == spark.createDataFrame([], scoring.ALERT_DDL).dtypes
    assert scoring.score_new_orders(sales, training, fitted, alerts, "2018-02-02 00:00:00").isEmpty()


def test_split_sizes_at_the_edges(spark):
    df = spark.range(1000).withColumnRenamed("id", "order_id")
    assert [model.split(df, test_size=t)[1].count() for t in (0.0, 1.0)] == [0, 1000]


def test_expression_equals_the_pipeline(spark, training, tmp_path, plan_of):
    fitted, scored = model.train(training, str(tmp_path / "model"))
    weights = Weights.of(fitted)
    names = ["order_id", *FEATURES, F.col("score").alias("of_model"), F.col("prediction").alias("class_of_model")]
    both = weights.predict(scored.select(*names))
    far = both.where("abs(score - of_model) > 1e-9 OR prediction <> class_of_model")
    assert far.isEmpty() and both.count() == scored.count() > 0
    plan = plan_of(weights.predict(training))
    assert "Python" not in plan and "UDF" not in plan.upper().replace("PUSHEDFILTERS", "")


def test_weights_survive_saving_and_leave_out_incomplete_rows(spark, training, tmp_path):
    fitted, _ = model.train(training, str(tmp_path / "model"))
    weights = Weights.of(fitted)
    weights.save(spark, str(tmp_path / "weights"))
    assert Weights.read(spark, str(tmp_path / "weights")) == weights
    gaps = training.withColumn("price_sum", F.when(F.col("order_id") != "7", F.col("price_sum")))
    assert weights.predict(gaps).where("order_id = '7'").isEmpty()
    assert weights.predict(gaps).count() == training.where("order_id <> '7'").count()
    flat = Weights(("price_sum",), (0.0,), (0.0,), (5.0,), 0.0)
    assert {r.score for r in flat.predict(training).collect()} == {0.5}
    with pytest.raises(TypeError):
        Weights.of(type(fitted)(stages=fitted.stages[::-1]))


def test_alerts_from_stored_weights_equal_those_of_the_pipeline(spark, sales, training, tmp_path, rows):
    fitted, _ = model.train(training, str(tmp_path / "model"))
    clock = "2018-02-01 00:00:00"
    one, two = (scoring.score_new_orders(sales, training, m, None, clock, 0.6) for m in (fitted, Weights.of(fitted)))
    assert rows(one) == rows(two)
