"""Numbers and running sums along an order over a whole table, without a task that sees all rows.

Rows are sorted into ranges; each range counts by itself, and is moved on by what the ranges
before it hold. Only one row per range is looked at in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import stored

_RANGE, _LOCAL = "_range", "_local"
# ``monotonically_increasing_id`` holds the row's number within its task in the lower bits.
_LOCAL_BITS = (1 << 33) - 1


def _sorted_ranges(rows: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """``rows`` in order, stored with the number of their range and their place in it."""
    ranged = rows.orderBy(*order).select(
        "*",
        F.spark_partition_id().alias(_RANGE),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL_BITS)).alias(_LOCAL),
    )
    return stored(ranged, "ranges")


def _before_each_range(sums: DataFrame, names: Sequence[str]) -> DataFrame:
    """Sums of all earlier ranges, from one row per range."""
    earlier = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(
        _RANGE, *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_before_{n}") for n in names]
    )


def numbered(rows: DataFrame, order: Sequence[Column | str], name: str = "position") -> DataFrame:
    """Add the place of each row in the order, from 0. Rows that tie get different places."""
    ranged = _sorted_ranges(rows, order)
    sizes = ranged.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("n"))
    return (
        ranged.join(_before_each_range(sizes, ["n"]), _RANGE)
        .withColumn(name, F.col("_before_n") + F.col(_LOCAL))
        .drop(_RANGE, _LOCAL, "_before_n")
    )


def running_sums(
    rows: DataFrame, order: Sequence[Column | str], values: Sequence[str], suffix: str = "_before"
) -> DataFrame:
    """Add, for each of ``values``, its sum over the rows before this one, as ``<value>_before``."""
    ranged = _sorted_ranges(rows, order)
    sums = ranged.groupBy(_RANGE).agg(*[F.sum(v).alias(v) for v in values])
    within = Window.partitionBy(_RANGE).orderBy(_LOCAL).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.select("*", *[F.sum(v).over(within).alias(f"_own_{v}") for v in values])
    out = local.join(_before_each_range(sums, values), _RANGE)
    for v in values:
        out = out.withColumn(f"{v}{suffix}", F.col(f"_before_{v}") + F.coalesce(f"_own_{v}", F.lit(0)))
    return out.drop(_RANGE, _LOCAL, *[f"_before_{v}" for v in values], *[f"_own_{v}" for v in values])
