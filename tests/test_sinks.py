"""Relational upsert sink over a journal, replayed in SQL; bucketed catalog tables."""

import json

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.operators.merge import upsert
from millrace.plans import facts
from millrace.sources.catalog import buckets_for, drop_database, save_bucketed
from millrace.sources.upsert_sink import merge_statement, register_upsert
from tests import journal_db

DDL = "order_id VARCHAR, item INTEGER, price DECIMAL(12,2), note VARCHAR, PRIMARY KEY (order_id, item)"


@pytest.fixture
def sink(spark, tmp_path):
    register_upsert(spark)
    (tmp_path / "journal").mkdir()

    def write(df, fail_on=None, **options):
        connect = json.dumps({"folder": str(tmp_path / "journal"), "fail_on": fail_on})
        writer = df.write.format("keyed_upsert").option("module", "tests.journal_db").option("connect", connect)
        for key, value in ({"table": "items", "keys": "order_id,item"} | options).items():
            writer = writer.option(key, value)
        writer.mode("append").save()

    write.journal = str(tmp_path / "journal")
    return write


def frame(spark, ids, note):
    return spark.createDataFrame([(str(i // 3), i % 3, None if i % 5 == 0 else note) for i in ids], "order_id string, item int, note string").select(
        "order_id", "item", (F.col("item") + 0.25).cast("decimal(12,2)").alias("price"), "note"
    )


def replayed(journal, first):
    """The target after its first rows and all that the journal says, by plain SQL."""
    connection = duckdb.connect()
    connection.execute(f"CREATE TABLE items ({DDL})")
    connection.executemany("INSERT INTO items VALUES (?, ?, ?, ?)", [list(r) for r in first.collect()])
    for sql, values in journal_db.statements(journal):
        connection.execute(sql, values)
    tables = [r[0] for r in connection.execute("SELECT table_name FROM information_schema.tables").fetchall()]
    return sorted(connection.execute("SELECT * FROM items").fetchall()), tables


def test_statements_give_the_merged_table(spark, sink):
    target, source = frame(spark, range(40), "old"), frame(spark, range(25, 4000), "new's \"own\"")
    sink(source.repartition(3))
    got, tables = replayed(sink.journal, target)
    want = upsert(target, source, ["order_id", "item"])
    assert got == sorted(tuple(r) for r in want.collect()) and tables == ["items"]
    inserts = [values for sql, values in journal_db.statements(sink.journal) if "_stage_" in sql and sql.startswith("INSERT INTO items_stage")]
    assert max(len(v) // 5 for v in inserts) == 1000 and sum(len(v) // 5 for v in inserts) == 3975


def test_a_failed_task_leaves_nothing(spark, sink):
    target, source = frame(spark, range(40), "old"), frame(spark, range(100), "new").repartition(4)
    with pytest.raises(Exception, match="refused"):
        sink(source.union(frame(spark, [3000], "bad")), fail_on="1000")
    got, tables = replayed(sink.journal, target)
    assert got == sorted(tuple(r) for r in target.collect()) and tables == ["items"]


def test_rows_without_a_commit_message_do_not_count():
    sql = merge_statement("t", "s", ["a", "b"], ["a"], 2, "on_conflict")
    assert sql == (
        'INSERT INTO t ("a", "b") SELECT "a", "b" FROM s WHERE upsert_mark IN (?, ?) '
        'ON CONFLICT ("a") DO UPDATE SET "b" = EXCLUDED."b"'
    )
    assert merge_statement("t", "s", ["a"], ["a"], 1, "on_conflict").endswith('ON CONFLICT ("a") DO NOTHING')
    other = merge_statement("t", "s", ["a", "b"], ["a"], 1, "on_duplicate_key", "%s")
    assert other.endswith("IN (%s) ON DUPLICATE KEY UPDATE `b` = VALUES(`b`)")


def test_empty_source_and_wrong_options(spark, sink):
    sink(frame(spark, range(3), "x").limit(0))
    assert replayed(sink.journal, frame(spark, range(3), "old"))[1] == ["items"]
    for options in ({"keys": "nobody"}, {"dialect": "other"}):
        with pytest.raises(Exception):
            sink(frame(spark, range(3), "x"), **options)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_by_order_are_not_shuffled(spark, rows, plan_of, no_broadcast):
    items = spark.range(600).selectExpr(
        "cast(id div 4 AS string) AS order_id", "cast(id % 4 AS int) AS order_item_id", "cast(id % 7 AS string) AS product_id",
        "cast(id % 3 AS string) AS seller_id", "cast(id AS decimal(12,2)) AS price", "cast(1 AS decimal(12,2)) AS freight_value",
    )
    orders = spark.range(150).selectExpr("cast(id AS string) AS order_id", "id AS customer")
    buckets = buckets_for(items, orders)
    tables = [save_bucketed(df, "by_order", n, ["order_id"], buckets) for n, df in (("items", items), ("orders", orders))]
    joined = facts.order_lines(tables[0]).join(tables[1], "order_id")
    plan = plan_of(joined)
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert rows(joined) == rows(facts.order_lines(items).join(orders, "order_id"))
    assert spark.sql("SELECT count(*) FROM by_order.items").first()[0] == 600
    # Replacing a table leaves one of its name.
    save_bucketed(orders.limit(10), "by_order", "orders", ["order_id"], buckets)
    assert spark.table("by_order.orders").count() == 10
    drop_database(spark, "by_order")
    assert "by_order" not in [d.name for d in spark.catalog.listDatabases()]
