"""Keyed merge of a source into a target, expressed as joins.

The result holds every row of the merged table plus ``_action``: ``insert``,
``update``, ``soft_delete`` or ``keep``. Keys are compared null-safe. The source
must hold at most one row per key (see ``operators.dedup``); the merge fails while
it runs when it doesn't.

Two plans give the same rows:

* *outer*: one full outer join. Both sides are shuffled once on the key.
* *lookup*: when Spark would broadcast the source, the target is streamed
  past it and is not shuffled at all; new keys are found with a semi join that
  reads only the target's key columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import any_changed
from millrace.session import fits_broadcast, stored

ACTION = "_action"


def merge_into(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    absent: Mapping[str, object] | None = None,
    newer_by: Sequence[str] | None = None,
    plan: str = "auto",
    unique: bool = False,
) -> DataFrame:
    """Merge ``source`` into ``target``.

    absent: column values set on target rows whose key is not in the source.
    newer_by: a matched row is replaced only when the source's values of these
        columns are not older than the target's.
    plan: ``outer``, ``lookup`` or ``auto`` (by the estimated size of the source).
    unique: the source is known to have one row per key, as after ``latest_per_key``; it is not
        read once more to check that.

    Source columns that the target lacks are added; target columns that the
    source lacks keep their values. Where keys can't be NULL, the outer plan checks them where
    the join brings them together, and reads the source once.
    """
    if plan == "auto":
        plan = "lookup" if fits_broadcast(source) and not fits_broadcast(target) else "outer"
    held = target.select(*_prefixed(target, "t"), F.lit(True).alias("_in_t"))
    # Plain equality where both can't be NULL: the join then lies by the keys themselves.
    nulls = {k for k in keys if target.schema[k].nullable or source.schema[k].nullable}
    given = source.select(*_prefixed(source, "s"))
    if unique:
        checked = F.lit(True)
    elif plan == "outer" and not nulls:
        checked = _no_error(F.count(F.lit(1)).over(Window.partitionBy(*[f"_s_{k}" for k in keys])) > 1, keys)
    else:
        checked = _checked_unique(source, keys)
    given = given.withColumn("_in_s", checked)
    pairs = {k: (F.col(f"_t_{k}"), F.col(f"_s_{k}")) for k in keys}
    same_key = reduce(Column.__and__, [t.eqNullSafe(s) if k in nulls else t == s for k, (t, s) in pairs.items()])
    project = _merged_columns(target, source, absent or {}, newer_by)

    if plan == "outer":
        return held.join(given, same_key, "full_outer").select(*project)
    if plan != "lookup":
        raise ValueError(f"unknown plan: {plan}")

    kept_or_updated = held.join(given, same_key, "left").select(*project)
    present = held.select(*[f"_t_{k}" for k in keys]).join(
        given.select(*[f"_s_{k}" for k in keys]), same_key, "left_semi"
    )
    new_rows = given.join(present, same_key, "left_anti")
    for field in target.schema.fields:
        new_rows = new_rows.withColumn(f"_t_{field.name}", F.lit(None).cast(field.dataType))
    inserted = new_rows.withColumn("_in_t", F.lit(None).cast("boolean")).select(*project)
    return kept_or_updated.unionByName(inserted)


def _checked_unique(source: DataFrame, keys: Sequence[str]) -> Column:
    """True; an error where the source repeats a key.

    The check is a subquery over the key columns alone, combined before its shuffle, of which
    one row comes back; it is part of the merge's plan and runs with it.
    """
    repeated = source.groupBy(*keys).count().where("count > 1").agg(F.count(F.lit(1)).alias("n"))
    return _no_error(repeated.scalar() > 0, keys)


def _no_error(repeats: Column, keys: Sequence[str]) -> Column:
    message = F.lit(f"merge: the source has several rows for one key {tuple(keys)}")
    return F.when(repeats, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """Update matched rows, insert the others; no action column."""
    return merge_into(target, source, keys, **options).drop(ACTION)


def replace_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], unique: bool = False) -> DataFrame:
    """All rows of ``source``, and the rows of ``target`` whose key it lacks; the target's columns.

    An upsert of whole rows without the action column. Only keys are shuffled: those that the
    source lacks are found first, and the target's rows are picked by them. Both sides are read
    twice, so they should be stored ones. Keys are compared null-safe; ``unique`` as for ``merge_into``.
    """
    names = [f"_s_{k}" for k in keys]

    def renamed(rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)])

    on = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)])
    # Stored, mostly without rows: so Spark knows their number and need not shuffle the target for them.
    lacked = stored(target.select(*keys).join(renamed(source), on, "left_anti"), "lacked-keys")
    kept = target.join(renamed(lacked), on, "left_semi")
    given = source if unique else source.where(_checked_unique(source, keys))
    return given.select(*target.columns).unionByName(kept)


def sync_snapshot(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge a complete snapshot: target rows that it lacks become inactive."""
    return merge_into(target, source, keys, absent={"is_active": False})


def sweep_deleted(target: DataFrame, source_keys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mark active target rows whose key no longer exists in the source as inactive.

    One left join with a flag: the target is read once and never rewritten twice.
    Keys of the source may repeat.
    """
    names = [f"_s_{k}" for k in keys]
    known = (
        source_keys.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)])
        .distinct()
        .withColumn("_known", F.lit(True))
    )
    same_key = reduce(
        Column.__and__,
        [target[k].eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)],
    )
    gone = F.col("_known").isNull() & F.coalesce(F.col("is_active"), F.lit(False))
    return target.join(known, same_key, "left").select(
        *[
            F.when(gone, F.lit(False)).otherwise(F.col(c)).alias(c) if c == "is_active" else c
            for c in target.columns
        ],
        F.when(gone, "soft_delete").otherwise("keep").alias(ACTION),
    )


def merge_metrics(merged: DataFrame) -> DataFrame:
    """Rows inserted, updated, soft-deleted and kept, and rows in all."""
    action = F.col(ACTION)
    return merged.agg(
        F.count_if(action == "insert").alias("rows_inserted"),
        F.count_if(action == "update").alias("rows_updated"),
        F.count_if(action == "soft_delete").alias("rows_soft_deleted"),
        F.count_if(action == "keep").alias("rows_kept"),
        F.count(F.lit(1)).alias("rows_output"),
    )


def _prefixed(df: DataFrame, side: str) -> list[Column]:
    return [F.col(c).alias(f"_{side}_{c}") for c in df.columns]


def _merged_columns(
    target: DataFrame,
    source: DataFrame,
    absent: Mapping[str, object],
    newer_by: Sequence[str] | None,
) -> list[Column]:
    in_target, in_source = F.col("_in_t").isNotNull(), F.col("_in_s").isNotNull()
    fresh = F.lit(True)
    if newer_by:
        had, got = (F.struct(*[F.col(f"_{side}_{c}") for c in newer_by]) for side in "ts")
        fresh = got >= had
    take_source = ~in_target | (in_source & fresh)

    def value(name: str) -> Column:
        column = F.col(f"_t_{name}") if name in target.columns else F.lit(None)
        if name in absent:
            column = F.when(~in_source, F.lit(absent[name])).otherwise(column)
        if name in source.columns:
            column = F.when(take_source, F.col(f"_s_{name}")).otherwise(column)
        return column.alias(name)

    losing = any_changed(
        [F.col(f"_t_{c}") for c in absent], [F.lit(v) for v in absent.values()]
    )
    action = (
        F.when(~in_target, "insert")
        .when(in_source & fresh, "update")
        .when(~in_source & losing, "soft_delete")
        .otherwise("keep")
    )
    names = [*target.columns, *(c for c in source.columns if c not in target.columns)]
    return [*map(value, names), action.alias(ACTION)]
