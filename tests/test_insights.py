"""Customer value, popularity and reputation on frames worked out by hand or in plain Python."""

import math
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.plans import insights

SALES = "order_id string, product_key string, seller_key string, customer_key string, sale_price decimal(12,2), quantity long, purchase_time_key int"


def day_key(day):
    return day.year * 10000 + day.month * 100 + day.day


@pytest.fixture(scope="module")
def sales(spark):
    start = date(2018, 1, 1)
    rows = []
    for i in range(400):
        when = day_key(start + timedelta(days=(i * 7) % 300))
        rows.append((str(i), f"p{i % 9}", f"s{i % 5}", None if i % 50 == 0 else f"c{i % 30}", i % 20 + 1, 1 + i % 3, when))
    return spark.createDataFrame(
        rows, "order_id string, product_key string, seller_key string, customer_key string, p int, quantity long, purchase_time_key int"
    ).selectExpr("order_id", "product_key", "seller_key", "customer_key", "cast(p AS decimal(12,2)) AS sale_price", "quantity", "purchase_time_key")


def test_history_of_one_customer(spark):
    rows = [("a", 10, 2, 20180101), ("a", 5, 1, 20180101), ("a", 7, 1, 20180331), ("a", 8, 1, 20180401), ("a", 1, 1, 20190101), ("b", 3, 1, None)]
    df = spark.createDataFrame(rows, "customer_key string, sale_price int, quantity long, purchase_time_key int")
    got = insights.customer_history(insights.purchases(df), "2018-04-11").collect()
    assert [(r.customer_key, r.frequency, r.spent, r.recent_peak, r.recency, r.age) for r in got] == [("a", 3, 40, 32, 10, 101)]


def test_rates_lie_between_the_own_and_the_mean(spark, sales):
    history = insights.customer_history(insights.purchases(sales), "2018-10-31")
    values = insights.lifetime_value(history, horizon=100).collect()
    mean = sum(r.frequency for r in values) / sum(r.age for r in values)
    assert len(values) == 30
    for r in values:
        low, high = sorted((r.frequency / r.age, mean))
        assert low - 1e-12 <= r.expected_purchases / 100 <= high + 1e-12
        assert r.lifetime_value == pytest.approx(r.expected_purchases * r.expected_each)
    assert insights.lifetime_value(history.limit(0)).count() == 0


@pytest.mark.parametrize("cuts", [("2018-03-01",), ("2018-02-01", "2018-06-15", "2018-06-16")])
def test_popularity_in_loads_equals_one_load(sales, cuts):
    end = "2018-10-31"
    whole = {r.product_key: (r.popularity, r.sold) for r in insights.popularity_of(sales, end).collect()}
    edges = [int(c.replace("-", "")) for c in cuts] + [99999999]
    state = insights.popularity_of(sales.where(F.col("purchase_time_key") <= edges[0]), cuts[0])
    for k, since in enumerate(cuts):
        fresh = sales.where(F.col("purchase_time_key").between(edges[k] + 1, edges[k + 1]))
        state = insights.advance_popularity(state, since, fresh, [*cuts, end][k + 1])
    got = {r.product_key: (r.popularity, r.sold) for r in state.collect()}
    assert got.keys() == whole.keys()
    assert all(got[p][1] == whole[p][1] and math.isclose(got[p][0], whole[p][0], rel_tol=1e-12) for p in whole)


def test_popularity_halves(spark):
    df = spark.createDataFrame([("p", 8, 20180101), ("p", 1, 20180401)], "product_key string, quantity long, purchase_time_key int")
    assert insights.popularity_of(df, "2018-04-01").first().popularity == 8 * 0.5 + 1
    assert insights.popularity_of(df, "2018-03-31").first().sold == 8


def test_reputation_is_drawn_to_the_category(spark):
    scores = [("c", "many", 100, 450, 2100), ("c", "few", 2, 2, 2), ("c", "mid", 50, 200, 850), ("d", "alone", 3, 9, 29), ("e", "x", 1, 5, 25), ("e", "y", 1, 5, 25)]
    df = spark.createDataFrame(scores, "category_key string, seller_key string, n long, total long, squares long")
    got = {r.seller_key: r for r in insights.seller_reputation(df).collect()}
    assert got["few"].mean_score == 1.0 < got["few"].reputation < got["few"].category_mean
    assert got["few"].own_weight < got["mid"].own_weight < got["many"].own_weight < 1
    assert got["alone"].reputation == got["alone"].mean_score == 3.0
    assert got["x"].reputation == got["y"].reputation == 5.0
    # By hand: the weights of category c from the moments of its three sellers.
    n, t, s = zip(*[r[2:] for r in scores[:3]], strict=True)
    between = sum(b * b / a for a, b in zip(n, t, strict=True))
    within = (sum(s) - between) / (sum(n) - 3)
    spread = (between - sum(t) ** 2 / sum(n)) / 2
    tau = (spread - within) / ((sum(n) - sum(a * a for a in n) / sum(n)) / 2)
    assert got["few"].own_weight == pytest.approx(2 * tau / (2 * tau + within))
