from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from millrace.functions.cleaning import clean, plausible_date, zip_code
from millrace.functions.columns import date_key, epoch_ms_to_ts, key_date, ratio


def one(spark, value, kind, expression):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(expression(F.col("x"))).first()[0]


def test_zip_is_padded_and_cut(spark):
    for given, wanted in (("1", "00001"), ("12345", "12345"), ("1234567", "12345"), (None, None)):
        assert one(spark, given, "string", zip_code) == wanted


def test_review_year_bounds_are_inclusive(spark):
    for year, kept in ((1999, False), (2000, True), (2050, True), (2051, False)):
        assert (one(spark, datetime(year, 6, 1), "timestamp_ntz", plausible_date) is not None) == kept
    assert one(spark, None, "timestamp_ntz", plausible_date) is None
    assert one(spark, "no date", "string", plausible_date) is None


def test_epoch_ms_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "Asia/Ho_Chi_Minh"):
            spark.conf.set("spark.sql.session.timeZone", name)
            got = one(spark, "1514851200123", "string", epoch_ms_to_ts)
            assert got == datetime(2018, 1, 2, 0, 0, 0, 123000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert one(spark, "-1", "string", epoch_ms_to_ts) == datetime(1969, 12, 31, 23, 59, 59, 999000)
    for malformed in ("abc", "", None, "99999999999999999"):
        assert one(spark, malformed, "string", epoch_ms_to_ts) is None


def test_date_key_and_back(spark):
    df = spark.createDataFrame([(datetime(2018, 2, 3, 4, 5),), (None,)], "t timestamp_ntz")
    keys = df.select(date_key("t").alias("k"))
    assert [r.k for r in keys.collect()] == [20180203, None]
    assert str(keys.select(key_date("k")).first()[0]) == "2018-02-03"
    bad = spark.createDataFrame([(20181345,)], "k int")
    assert bad.select(key_date("k")).first()[0] is None


def test_ratio_by_zero_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0)], "a double, b double")
    assert df.select(ratio(F.col("a"), F.col("b"))).first()[0] is None


def test_customers_fill_and_normalise(spark, rows):
    df = spark.createDataFrame(
        [(" a ", "7", "  Hanoi ", "hn"), ("b", None, None, None)],
        "customer_id string, customer_zip_code_prefix string, customer_city string, customer_state string",
    )
    assert rows(clean(df, "customers")) == [
        ("a", "00007", "hanoi", "HN"),
        ("b", None, "unknown", "UN"),
    ]


def test_malformed_measures_become_defaults(spark):
    items = spark.createDataFrame(
        [("12.50", "abc"), ("", None)], "price string, freight_value string"
    )
    zero = Decimal("0.00")
    assert [tuple(r) for r in clean(items, "order_items").collect()] == [
        (Decimal("12.50"), zero),
        (zero, zero),
    ]
    payments = spark.createDataFrame(
        [("x", None, " VOUCHER ")],
        "payment_value string, payment_installments string, payment_type string",
    )
    assert tuple(clean(payments, "order_payments").first()) == (zero, 1, "voucher")


def test_only_present_time_columns_are_decoded(spark):
    df = spark.createDataFrame(
        [("1", " Delivered ", "0")],
        "order_id string, order_status string, order_approved_at string",
    )
    cleaned = clean(df, "orders")
    assert cleaned.columns == df.columns
    assert tuple(cleaned.first()) == ("1", "delivered", datetime(1970, 1, 1))


def test_entity_without_rules_is_trimmed_only(spark):
    df = spark.createDataFrame([(" Auto ", 3)], "product_category_name string, n int")
    assert tuple(clean(df, "product_category_name_translation").first()) == ("Auto", 3)


def test_cleaning_is_one_projection(spark, plan_of):
    df = spark.range(3).select(F.lit(" x ").alias("customer_city"), F.lit("y").alias("customer_state"),
                               F.col("id").cast("string").alias("customer_zip_code_prefix"))
    plan = clean(df, "customers")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") == 1
