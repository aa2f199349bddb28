"""Customer value, product popularity, seller reputation: derived from facts by closed formulas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import key_date, ratio

HALF_LIFE_DAYS = 90
HORIZON_DAYS = 365
RECENT_DAYS = 90


# --- customer-lifetime value ---


def purchases(fact_sales: DataFrame) -> DataFrame:
    """(customer_key, day, spent): one row per customer and day with a purchase."""
    return (
        fact_sales.where("customer_key IS NOT NULL AND purchase_time_key IS NOT NULL")
        .groupBy("customer_key", key_date("purchase_time_key").alias("day"))
        .agg(F.sum(F.col("sale_price") * F.col("quantity")).alias("spent"))
    )


def customer_history(bought: DataFrame, as_of: str) -> DataFrame:
    """Per customer: purchase days, money, recency, age and the best RECENT_DAYS.

    Days after ``as_of`` are left out. recent_peak is the most spent in any RECENT_DAYS days
    that end with a purchase, from a frame over the range of days.
    """
    end = F.lit(as_of).cast("date")
    number = F.datediff("day", F.lit("1970-01-01").cast("date"))
    recent = Window.partitionBy("customer_key").orderBy("number").rangeBetween(1 - RECENT_DAYS, 0)
    rows = bought.where(F.col("day") <= end).withColumn("number", number)
    rows = rows.withColumn("recent", F.sum("spent").over(recent))
    return rows.groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("frequency"),
        F.sum("spent").alias("spent"),
        F.max("recent").alias("recent_peak"),
        F.datediff(end, F.max("day")).alias("recency"),
        (F.datediff(end, F.min("day")) + 1).alias("age"),
    )


def lifetime_value(history: DataFrame, horizon: int = HORIZON_DAYS) -> DataFrame:
    """Expected purchases and spending of each customer within ``horizon`` days.

    Purchases are Poisson with a rate that is Gamma distributed among customers. Its mean m
    and variance v are fitted by moments: m = sum x / sum t, v = (sum (x - m t)^2 - sum x) / sum t^2, at
    least 0; the customer's rate is then (m^2 + v x) / (m + v t) per day. One row of sums is all that
    customers share. Spending per purchase is the customer's own mean, drawn to the mean of all
    by one purchase's weight.
    """
    x, t = F.col("frequency").cast("double"), F.col("age").cast("double")
    fit = history.agg(
        *[F.sum(c).alias(n) for n, c in (("x", x), ("t", t), ("xx", x * x), ("xt", x * t), ("tt", t * t))],
        F.sum("spent").cast("double").alias("s"),
    ).select(F.struct("*").alias("f"))
    f = F.col("_fit")
    m, each = ratio(f["x"], f["t"]), ratio(f["s"], f["x"])
    v = F.greatest(F.lit(0.0), ratio(f["xx"] - 2 * m * f["xt"] + m * m * f["tt"] - f["x"], f["tt"]))
    rate = (m * m + v * x) / (m + v * t)
    return (
        history.withColumn("_fit", fit.scalar())
        .withColumn("expected_purchases", horizon * rate)
        .withColumn("expected_each", (F.col("spent").cast("double") + each) / (x + 1))
        .withColumn("lifetime_value", F.col("expected_purchases") * F.col("expected_each"))
        .drop("_fit")
    )


# --- product popularity ---


def _decay(days: Column, half_life: int) -> Column:
    return F.pow(F.lit(0.5), days / half_life)


def popularity_of(fact_sales: DataFrame, as_of: str, half_life: int = HALF_LIFE_DAYS) -> DataFrame:
    """(product_key, popularity, sold): pieces sold, each halved every ``half_life`` days up to ``as_of``."""
    age = F.datediff(F.lit(as_of).cast("date"), key_date("purchase_time_key"))
    sold = fact_sales.where(F.col("product_key").isNotNull() & (age >= 0))
    return sold.groupBy("product_key").agg(
        F.sum(F.col("quantity") * _decay(age, half_life)).alias("popularity"),
        F.sum("quantity").alias("sold"),
    )


def advance_popularity(
    state: DataFrame, since: str, fresh_sales: DataFrame, as_of: str, half_life: int = HALF_LIFE_DAYS
) -> DataFrame:
    """The state at ``as_of`` from the state at ``since`` and the sales that it does not have.

    Decay is the same factor for all of a product's past, so one row per product is all that is
    kept; both sides are summed before they meet.
    """
    factor = _decay(F.datediff(F.lit(as_of).cast("date"), F.lit(since).cast("date")), half_life)
    aged = state.withColumn("popularity", F.col("popularity") * factor)
    return (
        aged.unionByName(popularity_of(fresh_sales, as_of, half_life))
        .groupBy("product_key")
        .agg(F.sum("popularity").alias("popularity"), F.sum("sold").alias("sold"))
    )


# --- seller reputation ---


def seller_scores(fact_sales: DataFrame, fact_reviews: DataFrame, dim_product: DataFrame) -> DataFrame:
    """(category_key, seller_key, n, total, squares): sums of review scores. An order's reviews
    count once for each seller and category in it; both sides are reduced to the order first."""
    products = dim_product.select("product_key", "category_key")
    sold = fact_sales.where("seller_key IS NOT NULL").join(products, "product_key")
    sold = sold.select("order_id", "seller_key", "category_key").distinct()
    score = F.col("Review_score").cast("long")
    reviewed = fact_reviews.where("Review_score IS NOT NULL").groupBy(F.col("Order_id").alias("order_id"))
    reviewed = reviewed.agg(F.count(score).alias("n"), F.sum(score).alias("total"), F.sum(score * score).alias("squares"))
    sums = [F.sum(c).alias(c) for c in ("n", "total", "squares")]
    return sold.join(reviewed, "order_id").groupBy("category_key", "seller_key").agg(*sums)


def seller_reputation(scores: DataFrame) -> DataFrame:
    """Each seller's mean score in a category, drawn to the category's mean.

    With n reviews, and variances s2 within and t2 between the sellers of the category, the
    weight of the own mean is n t2 / (n t2 + s2). Variances are by the moments of a one-way layout,
    t2 at least 0; a category of one seller, or without variance, has the plain mean.
    """
    n, total = F.col("n").cast("double"), F.col("total").cast("double")
    per_category = scores.groupBy("category_key").agg(
        F.count(F.lit(1)).cast("double").alias("k"),
        F.sum("n").cast("double").alias("all_n"),
        F.sum("total").cast("double").alias("all_total"),
        F.sum("squares").cast("double").alias("all_squares"),
        F.sum(F.col("n") * F.col("n")).cast("double").alias("n_squares"),
        F.sum(F.round(total * total / n, 9).cast("decimal(38,9)")).cast("double").alias("between"),
    )
    k, all_n = F.col("k"), F.col("all_n")
    mean = F.col("all_total") / all_n
    within = ratio(F.col("all_squares") - F.col("between"), all_n - k)
    spread = ratio(F.col("between") - F.col("all_total") * F.col("all_total") / all_n, k - 1)
    size = ratio(all_n - F.col("n_squares") / all_n, k - 1)
    between = F.greatest(F.lit(0.0), ratio(spread - within, size))
    fitted = per_category.select(
        "category_key",
        mean.alias("category_mean"),
        within.alias("within"),
        between.alias("between"),
    )
    joined = scores.join(fitted, "category_key")
    own = total / n
    weight = F.coalesce(ratio(n * F.col("between"), n * F.col("between") + F.col("within")), F.lit(0.0))
    return joined.select(
        "category_key",
        "seller_key",
        F.col("n").alias("reviews"),
        own.alias("mean_score"),
        "category_mean",
        weight.alias("own_weight"),
        (weight * own + (1 - weight) * F.col("category_mean")).alias("reputation"),
    )
