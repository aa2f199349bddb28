import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from millrace.operators import merge
from millrace.operators.merge import merge_into

DDL = "k int, v string, is_active boolean"


def frame(spark, data, ddl=DDL):
    return spark.createDataFrame(data, ddl)


@pytest.mark.parametrize("plan", ["outer", "lookup"])
class TestMerge:
    def test_actions(self, spark, rows, plan):
        target = frame(spark, [(1, "a", True), (2, "b", True), (3, "c", True)])
        source = frame(spark, [(2, "B", True), (4, "d", True)])
        assert rows(merge.merge_into(target, source, ["k"], plan=plan)) == [
            (1, "a", True, "keep"),
            (2, "B", True, "update"),
            (3, "c", True, "keep"),
            (4, "d", True, "insert"),
        ]

    def test_null_keys_match(self, spark, rows, plan):
        target = frame(spark, [(None, "a", True)])
        source = frame(spark, [(None, "b", True)])
        assert rows(merge.merge_into(target, source, ["k"], plan=plan)) == [
            (None, "b", True, "update")
        ]

    def test_null_value_replaces(self, spark, rows, plan):
        target, source = frame(spark, [(1, "a", True)]), frame(spark, [(1, None, True)])
        assert rows(merge.upsert(target, source, ["k"], plan=plan)) == [(1, None, True)]

    def test_empty_sides(self, spark, rows, plan):
        some, none = frame(spark, [(1, "a", True)]), frame(spark, [])
        assert rows(merge.merge_into(some, none, ["k"], plan=plan)) == [(1, "a", True, "keep")]
        assert rows(merge.merge_into(none, some, ["k"], plan=plan)) == [(1, "a", True, "insert")]
        assert rows(merge.merge_into(none, none, ["k"], plan=plan)) == []

    def test_soft_delete_and_return(self, spark, rows, plan):
        target = frame(spark, [(1, "a", True), (2, "b", False), (3, "c", False)])
        source = frame(spark, [(2, "b", True)])
        merged = merge.merge_into(target, source, ["k"], absent={"is_active": False}, plan=plan)
        assert rows(merged) == [
            (1, "a", False, "soft_delete"),
            (2, "b", True, "update"),
            (3, "c", False, "keep"),
        ]

    def test_older_change_does_not_win(self, spark, rows, plan):
        ddl = "k int, v string, ts int"
        target = frame(spark, [(1, "new", 10), (2, "old", 10), (3, "x", None)], ddl)
        source = frame(spark, [(1, "late", 5), (2, "newer", 11), (3, "y", 1)], ddl)
        merged = merge.merge_into(target, source, ["k"], newer_by=["ts"], plan=plan)
        assert rows(merged, "k", "v", "_action") == [
            (1, "new", "keep"),
            (2, "newer", "update"),
            (3, "y", "update"),
        ]

    def test_new_and_missing_columns(self, spark, rows, plan):
        target = frame(spark, [(1, "a", 7), (2, "b", 8)], "k int, v string, held int")
        source = frame(spark, [(2, "B", "x"), (3, "c", "y")], "k int, v string, added string")
        merged = merge.upsert(target, source, ["k"], plan=plan)
        assert merged.columns == ["k", "v", "held", "added"]
        assert rows(merged) == [(1, "a", 7, None), (2, "B", 8, "x"), (3, "c", None, "y")]

    def test_composite_key(self, spark, rows, plan):
        ddl = "o string, i int, v int"
        target = frame(spark, [("a", 1, 1), ("a", 2, 1)], ddl)
        source = frame(spark, [("a", 2, 9), ("b", 1, 9)], ddl)
        assert rows(merge.upsert(target, source, ["o", "i"], plan=plan)) == [
            ("a", 1, 1),
            ("a", 2, 9),
            ("b", 1, 9),
        ]


side = st.dictionaries(st.integers(0, 8) | st.none(), st.sampled_from("abc"), max_size=7)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(held=side, given_=side)
def test_both_plans_agree_and_merging_twice_changes_nothing(spark, rows, held, given_):
    target = frame(spark, [(k, v, True) for k, v in held.items()])
    source = frame(spark, [(k, v, True) for k, v in given_.items()])
    once = merge.sync_snapshot(target, source, ["k"]).drop("_action")
    merged = rows(once)
    assert {k: v for k, v, _ in merged} == held | given_
    assert {k for k, _, active in merged if active} == set(given_)
    assert rows(merge.sync_snapshot(once, source, ["k"]).drop("_action")) == merged
    lookup = merge.merge_into(target, source, ["k"], absent={"is_active": False}, plan="lookup")
    assert rows(lookup.drop("_action")) == merged


def test_sweep(spark, rows):
    target = frame(spark, [(1, "a", True), (2, "b", True), (3, "c", False), (None, "d", True)])
    keys = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(merge.sweep_deleted(target, keys, ["k"])) == [
        (1, "a", True, "keep"),
        (2, "b", False, "soft_delete"),
        (3, "c", False, "keep"),
        (None, "d", True, "keep"),
    ]


def test_metrics(spark):
    target = frame(spark, [(1, "a", True), (2, "b", True), (3, "c", False)])
    source = frame(spark, [(2, "B", True), (4, "d", True), (5, "e", True)])
    metrics = merge.merge_metrics(merge.sync_snapshot(target, source, ["k"])).first().asDict()
    assert metrics == {
        "rows_inserted": 2, "rows_updated": 1, "rows_soft_deleted": 1, "rows_kept": 1, "rows_output": 5,
    }


def test_small_source_does_not_shuffle_the_target(spark, plan_of, tmp_path):
    path = str(tmp_path / "target")
    spark.range(2_000_000).selectExpr("id AS k", "repeat(cast(id AS string), 3) AS v").write.parquet(path)
    target, source = spark.read.parquet(path), spark.range(5).selectExpr("id AS k", "'n' AS v")
    merged = merge.merge_into(target, source, ["k"])
    joins = [line for line in plan_of(merged).splitlines() if "Join" in line]
    assert [j.count("LeftOuter") for j in joins] == [1, 0, 0]
    assert "BroadcastHashJoin" in joins[0]  # target past the source
    assert "LeftAnti" in joins[1]  # of the source only
    assert "BroadcastHashJoin" in joins[2] and "LeftSemi" in joins[2]  # the target's keys
    assert merged.where("v = 'n'").count() == 5 and merged.count() == 2_000_000


def test_large_source_is_one_outer_join(spark, plan_of):
    df = spark.range(10_000_000).selectExpr("id AS k", "id AS v")
    assert plan_of(merge.merge_into(df, df, ["k"])).count("FullOuter") == 1


@pytest.mark.parametrize("plan", ["outer", "lookup"])
def test_repeated_source_key_fails(spark, plan):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, "b"), (2, "c"), (1, "d")], "k int, v string")
    with pytest.raises(Exception, match="several rows for one key"):
        merge_into(target, source, ["k"], plan=plan).collect()
    assert merge_into(target, source.where("v <> 'd'"), ["k"], plan=plan).count() == 2


def test_both_plans_agree(spark, rows):
    target = spark.createDataFrame([(1, "a", True), (None, "n", True), (3, "c", True)], "k int, v string, is_active boolean")
    source = spark.createDataFrame([(1, "b", 9), (None, "m", 8), (4, "d", 7)], "k int, v string, extra int")
    options = {"absent": {"is_active": False}}
    outer, lookup = (merge_into(target, source, ["k"], plan=p, **options) for p in ("outer", "lookup"))
    assert outer.columns == lookup.columns and rows(outer) == rows(lookup)
