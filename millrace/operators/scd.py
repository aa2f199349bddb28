"""Slowly changing dimensions of type 2, and the join of facts to the version valid at a time.

A version is valid in ``[effective_date, expiry_date)``; NULL expiry means open.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import any_changed, packed_key, packed_number, unpacked_key, version_key
from millrace.session import fits_broadcast, may_broadcast, stored

# Fixed value: start of validity of the versions of a first load.
FIRST_EFFECTIVE = "1900-01-01 00:00:00"

_TIMESTAMP = "timestamp_ntz"


def _at(when: str) -> Column:
    return F.lit(when).cast(_TIMESTAMP)


def _version(source: Sequence[Column], business_key: str, surrogate: str, since: str) -> list[Column]:
    """Columns of a version that opens at ``since``."""
    return [
        *source,
        version_key(business_key, _at(since)).alias(surrogate),
        _at(since).alias("effective_date"),
        F.lit(None).cast(_TIMESTAMP).alias("expiry_date"),
        F.lit(1).alias("is_current"),
    ]


def scd2_initial(
    df: DataFrame, business_key: str, surrogate: str, since: str = FIRST_EFFECTIVE
) -> DataFrame:
    return df.select(*_version([F.col(c) for c in df.columns], business_key, surrogate, since))


def scd2_changed(
    dimension: DataFrame, batch: DataFrame, business_key: str, tracked: Sequence[str]
) -> DataFrame:
    """Batch rows whose current version differs in a tracked column (null-safe)."""
    current = dimension.where("is_current = 1").select(
        *[F.col(c).alias(f"_d_{c}") for c in (business_key, *tracked)]
    )
    differs = any_changed(
        [F.col(c) for c in tracked], [F.col(f"_d_{c}") for c in tracked]
    )
    same_key = F.col(business_key).eqNullSafe(F.col(f"_d_{business_key}"))
    return batch.join(current, same_key & differs, "left_semi")


def scd2_staged(
    dimension: DataFrame, batch: DataFrame, business_key: str, tracked: Sequence[str]
) -> DataFrame:
    """Changed rows with a NULL ``merge_key`` (to insert) and all rows keyed (to match)."""
    key_type = batch.schema[business_key].dataType
    reopened = scd2_changed(dimension, batch, business_key, tracked).select(
        F.lit(None).cast(key_type).alias("merge_key"), "*"
    )
    return reopened.unionByName(batch.select(F.col(business_key).alias("merge_key"), "*"))


def scd2_apply(
    dimension: DataFrame,
    batch: DataFrame,
    business_key: str,
    surrogate: str,
    tracked: Sequence[str],
    now: str,
) -> DataFrame:
    """Close changed versions at ``now`` and open new ones; keys absent from the batch stay.

    A version that was opened at this very ``now`` is replaced, not closed: a load that is
    repeated with its clock leaves no empty interval, and no surrogate twice. The load fails
    when a changed key has a version from after ``now``.

    Closed versions bypass the join. Current versions and the batch both hold
    one row per key, so one full outer join has no hot key; a changed pair
    leaves it as two rows.
    """
    history = dimension.where("is_current = 0")
    names = dimension.columns
    current = dimension.where("is_current = 1").select(
        *[F.col(c).alias(f"_d_{c}") for c in names], F.lit(True).alias("_in_d")
    )
    given = batch.withColumn("_in_b", F.lit(True))
    pairs = current.join(
        given, F.col(f"_d_{business_key}").eqNullSafe(F.col(business_key)), "full_outer"
    )

    is_new = F.col("_in_d").isNull()
    changed = (
        F.col("_in_d").isNotNull()
        & F.col("_in_b").isNotNull()
        & any_changed([F.col(c) for c in tracked], [F.col(f"_d_{c}") for c in tracked])
    )

    def held(closed: bool) -> Column:
        closing = {"expiry_date": _at(now), "is_current": F.lit(0)} if closed else {}
        return F.struct(*[closing.get(c, F.col(f"_d_{c}")).alias(c) for c in names])

    opening = _version([F.col(c) for c in batch.columns], business_key, surrogate, now)
    opened = F.struct(*opening)
    ordered = F.struct(*[opened[c].alias(c) for c in names])
    since = F.col("_d_effective_date")
    late = F.raise_error(F.concat(F.lit("version from after the load's clock: "), F.col(f"_d_{surrogate}")))
    rows = (
        F.when(changed & (since > _at(now)), F.array(F.when(late.isNull(), ordered)))
        .when(changed & (since == _at(now)), F.array(ordered))
        .when(changed, F.array(held(closed=True), ordered))
        .when(is_new, F.array(ordered))
        .otherwise(F.array(held(closed=False)))
    )
    return pairs.select(F.inline(rows)).unionByName(history)


# From so many rows on, facts and versions together, a key is split by time ranges.
HOT_ROWS = 5_000_000
# Candidates per fact, on average over the keys, up to which they are looked up.
FEW_VERSIONS = 8
MOST_SLICES = 256
# Counted versions up to which a dimension is broadcast: some 100 MB in memory at most.
BROADCAST_VERSIONS = 500_000
# Versions of any one key up to which they are attached to facts as a list.
MOST_LISTED = 32


def asof_join(
    facts: DataFrame,
    dimension: DataFrame,
    on: Mapping[str, str],
    at: str,
    take: Sequence[str],
    plan: str = "lookup",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join to the version valid at ``at``; ``take`` columns are added, facts never multiply.

    on: fact column → business key of the dimension. Facts whose key or time is NULL match
    nothing. Versions of one key must not overlap.

    plan ``lookup``: key equality with the interval as residual condition. Every fact meets
    all versions of its key, but a broadcast dimension leaves the facts where they are.
    plan ``carry``: facts and versions are sorted together by key and time, once, and the last
    version is carried forward; no row is made beyond these. Keys of more than ``hot_rows`` rows
    are split into time ranges, each of which is handed the version that was last before it.
    ``auto`` looks up what Spark would broadcast, or what has few versions a key, and carries
    otherwise; to know that it counts the versions. Few in all are broadcast, as their number is
    known then, unless the session turns broadcasts off.
    """
    marks = {c: f"_v_{c}" for c in (*on.values(), "effective_date", "expiry_date")}
    versions = dimension.select(
        *[F.col(c).alias(alias) for c, alias in marks.items()], *[F.col(c) for c in take]
    )
    if plan == "auto":
        if fits_broadcast(versions):
            plan = "lookup"
        else:
            keys = [F.col(marks[k]) for k in on.values()]
            n, few = _few_versions(versions, keys)
            plan = "lookup" if few else "carry"
            if few and n <= BROADCAST_VERSIONS and may_broadcast(versions):
                versions = F.broadcast(versions)
    if plan == "carry":
        return _carried(facts, versions, on, at, take, hot_rows)
    if plan != "lookup":
        raise ValueError(f"unknown plan: {plan}")
    expiry = F.col(marks["expiry_date"])
    valid = (F.col(at) >= F.col(marks["effective_date"])) & (
        (F.col(at) < expiry) | expiry.isNull()
    )
    for fact_column, key in on.items():
        valid = (F.col(fact_column) == F.col(marks[key])) & valid
    return facts.join(versions, valid, "left").drop(*marks.values())


def _few_versions(versions: DataFrame, keys: Sequence[Column]) -> tuple[int, bool]:
    """The number of versions, and whether keys have few of them on average."""
    counted = versions.agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.struct(*keys)).alias("keys")
    ).first()
    return counted["n"], counted["n"] <= FEW_VERSIONS * max(1, counted["keys"])


def few_broadcast(versions: DataFrame) -> DataFrame:
    """``versions`` with a hint where they are few by count, though Spark takes them for more by their
    files; without one if the session turns broadcasts off."""
    if fits_broadcast(versions) or not may_broadcast(versions):
        return versions
    return F.broadcast(versions) if versions.count() <= BROADCAST_VERSIONS else versions


def join_versions(rows: DataFrame, dimension: DataFrame, key: str, take: Sequence[str | Column]) -> DataFrame:
    """Left join by surrogate, which ``rows`` hold packed under ``key``, to the columns ``take`` of its version."""
    versions = dimension.select(packed_key(key).alias("_v_key"), *take)
    return rows.join(few_broadcast(versions), F.col(key) == F.col("_v_key"), "left").drop("_v_key")


def numbered_values(versions: DataFrame, name: str) -> tuple[DataFrame, DataFrame | None]:
    """``versions`` with numbers in place of the values of ``name``, and the table of these: facts that are
    shuffled carry a few bytes until ``named_values``. NULL stays NULL. Values that are too many to be
    broadcast are left as they are, and there is no table."""
    values = versions.select(name).where(F.col(name).isNotNull()).distinct()
    if not may_broadcast(versions) or values.count() > BROADCAST_VERSIONS:
        return versions, None
    # Stored, so that each reader sees the same numbers; counted, so that one task may number them.
    number = F.monotonically_increasing_id().cast("int").alias("_number")
    values = stored(values.coalesce(1).select(F.col(name).alias("_value"), number), "numbers")
    coded = versions.join(F.broadcast(values), F.col(name) == F.col("_value"), "left")
    return coded.drop(name, "_value").withColumnRenamed("_number", name), values


def named_values(rows: DataFrame, name: str, values: DataFrame | None) -> DataFrame:
    """``rows`` with the values again that ``numbered_values`` put numbers in place of."""
    if values is None:
        return rows
    named = rows.join(F.broadcast(values), F.col(name) == F.col("_number"), "left")
    return named.drop(name, "_number").withColumnRenamed("_value", name)


def listable(dimension: DataFrame, key: str) -> bool:
    """Whether no key has more versions than ``with_versions`` should list."""
    counts = dimension.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return (counts.agg(F.max("n")).first()[0] or 0) <= MOST_LISTED


def with_versions(facts: DataFrame, dimension: DataFrame, fact_key: str, key: str, surrogate: str, name: str) -> DataFrame:
    """Add ``name``, the list of all versions of each fact's key, of which ``valid_keys`` picks by
    time. So facts can be brought to a dimension before the time they need is joined to them.

    Facts hold the key by ``packed_number``. Surrogates that ``version_key`` makes of key and start,
    which the list holds anyway, are left empty in it: facts need not carry digests.
    """
    made = F.col(surrogate) == version_key(key, F.col("effective_date"))
    version = F.struct(
        F.col("effective_date").alias("since"),
        F.col("expiry_date").alias("until"),
        F.when(made, F.lit(b"")).otherwise(packed_key(surrogate)).alias("key"),
    )
    known = dimension.where(F.col(key).isNotNull())
    lists = known.groupBy(packed_number(key).alias("_v_key")).agg(F.collect_list(version).alias(name))
    return facts.join(lists, F.col(fact_key) == F.col("_v_key"), "left").drop("_v_key")


def valid_keys(versions: str, at: str) -> Column:
    """Starts and packed surrogates of the listed versions that are valid at ``at``; one at most, unless
    they overlap."""
    valid = F.filter(
        versions, lambda v: (F.col(at) >= v["since"]) & ((F.col(at) < v["until"]) | v["until"].isNull())
    )
    return F.transform(valid, lambda v: F.struct(v["since"].alias("since"), v["key"].alias("key")))


def valid_surrogate(version: str, key: str) -> Column:
    """The surrogate of one of ``valid_keys``; ``key`` is the business key as text."""
    made = version_key(key, F.col(version)["since"])
    held = F.col(version)["key"]
    return F.when(held == F.lit(b""), made).otherwise(unpacked_key(held))


def _carried(
    facts: DataFrame,
    versions: DataFrame,
    on: Mapping[str, str],
    at: str,
    take: Sequence[str],
    hot_rows: int,
) -> DataFrame:
    keys = [f"_k{i}" for i in range(len(on))]
    types = dict(versions.dtypes)
    held = F.struct(F.col("_v_expiry_date").alias("expiry"), *[F.col(c) for c in take])
    opened = versions.select(
        *[F.col(f"_v_{c}").alias(k) for k, c in zip(keys, on.values(), strict=True)],
        F.col("_v_effective_date").alias("_t"),
        held.alias("_version"),
        F.lit(None).cast(facts.schema).alias("_fact"),
    ).where(_none_null([*keys, "_t"]))
    asked = facts.select(
        *[F.col(f).cast(types[f"_v_{c}"]).alias(k) for k, (f, c) in zip(keys, on.items(), strict=True)],
        F.col(at).cast(types["_v_effective_date"]).alias("_t"),
        F.lit(None).cast(opened.schema["_version"].dataType).alias("_version"),
        F.struct(*[F.col(c) for c in facts.columns]).alias("_fact"),
    )
    never = asked.where(~_none_null([*keys, "_t"]))
    rows = asked.where(_none_null([*keys, "_t"])).unionByName(opened)

    rows = _sliced(rows, keys, hot_rows)
    # At one time a version comes before facts; of versions, one that is still open comes last.
    order = [
        F.col("_t").asc_nulls_first(),
        F.col("_fact").isNotNull(),
        F.col("_version.expiry").asc_nulls_last(),
    ]
    frame = Window.partitionBy(*keys, "_slice").orderBy(*order)
    frame = frame.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = rows.withColumn("_version", F.last("_version", ignorenulls=True).over(frame))
    found = last.where(F.col("_fact").isNotNull()).select("_fact", "_t", "_version")
    found = found.unionByName(never.select("_fact", "_t", "_version"))
    expiry = F.col("_version.expiry")
    valid = (F.col("_t") < expiry) | expiry.isNull()
    return found.select("_fact.*", *[F.when(valid, F.col(f"_version.{c}")).alias(c) for c in take])


def _none_null(names: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(n).isNotNull() for n in names])


def _sliced(rows: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Add ``_slice``, the time range of a row within its key, and the versions handed to slices.

    Only hot keys have more than one slice; ranges hold about as many rows each. Facts of
    one moment that fills several ranges are shared among these, any of which serves them.
    """
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows)
    sizes = stored(sizes, "hot-keys")
    most = sizes.agg(F.max("n")).first()[0]
    if most is None:
        return rows.withColumn("_slice", F.lit(0))
    n = min(MOST_SLICES, math.ceil(most / hot_rows) + 1)
    parts = [F.lit(k / n) for k in range(1, n)]
    hot = rows.join(sizes.select(*keys), keys, "left_semi")
    cuts = hot.groupBy(*keys).agg(
        F.percentile_approx("_t", F.array(*parts), F.lit(20 * n)).alias("_cuts")
    )
    cuts = stored(cuts, "cuts")

    rows = rows.join(cuts, keys, "left")
    t = F.col("_t")
    below = F.size(F.filter("_cuts", lambda c: c < t))
    upto = F.size(F.filter("_cuts", lambda c: c <= t))
    # By partition, which a task that is run again has again; within one, rows of a moment stay together.
    share = F.pmod(F.xxhash64(t, F.spark_partition_id()), upto - below + 1).cast("int")
    number = F.when(F.col("_fact").isNull(), below).otherwise(below + share)
    rows = rows.withColumn("_slice", F.when(F.col("_cuts").isNull(), 0).otherwise(number)).drop("_cuts")

    own = rows.where(F.col("_fact").isNull()).join(cuts.select(*keys), keys, "left_semi")
    newest = F.max_by("_version", F.struct("_t", F.col("_version.expiry").isNull(), "_version.expiry"))
    own = own.groupBy(*keys, "_slice").agg(newest.alias("_version"))
    every = cuts.select(*keys, F.explode(F.sequence(F.lit(0), F.size("_cuts"))).alias("_slice"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    handed = every.join(own, [*keys, "_slice"], "left").select(
        *keys, "_slice", F.last("_version", ignorenulls=True).over(before).alias("_version")
    )
    blank = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema if f.name in ("_t", "_fact")}
    handed = handed.where(F.col("_version").isNotNull()).select("*", *blank.values())
    return rows.unionByName(handed)
