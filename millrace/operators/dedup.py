"""One row per key.

``row_number() = 1`` is planned with a group limit before the shuffle: each map
task keeps at most one row per key, so a key that holds a large share of the
rows sends one row per task and never gathers in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType, VariantType

_RANK = "__rank"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in ``order``. NULL keys form one group."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)
    )


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    latest_by: Sequence[str],
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """The row with the highest ``latest_by`` per key.

    Equal rows are ranked by ``ties``, by default all remaining sortable
    columns, so the result does not depend on how the input is partitioned.
    """
    if ties is None:
        used = {*keys, *latest_by}
        ties = [
            f.name
            for f in df.schema.fields
            if f.name not in used and not isinstance(f.dataType, MapType | StructType | VariantType)
        ]
    order = [F.col(c).desc_nulls_last() for c in (*latest_by, *ties)]
    return first_per_key(df, keys, order)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()
