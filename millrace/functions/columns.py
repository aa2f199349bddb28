"""Column expressions shared by the layers. All are built-in functions, inside code generation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegralType

# First and last millisecond of the years 1 to 9999.
_EPOCH_MS_RANGE = (-62_135_596_800_000, 253_402_300_799_999)


def hash_key(natural_key: str | Column) -> Column:
    """Surrogate of a natural key; NULL stays NULL."""
    column = F.col(natural_key) if isinstance(natural_key, str) else natural_key
    return F.md5(column.cast("string"))


def version_key(business_key: str, effective: Column) -> Column:
    """Surrogate of one dimension version: key and start of validity, so a re-run repeats it."""
    return F.md5(
        F.concat(F.col(business_key).cast("string"), F.lit("|"), effective.cast("string"))
    )


def packed_key(key: str | Column) -> Column:
    """A surrogate as bytes: a digest in half its length, other text as it is; a byte in front tells
    which. Equal where the keys are. Digests do not compress, and a shuffle carries what they take."""
    column = F.col(key) if isinstance(key, str) else key
    digest = F.concat(F.lit(b"\x01"), F.unhex(column))
    return F.when(column.rlike("^[0-9a-f]{32}$"), digest).otherwise(F.concat(F.lit(b"\x00"), F.encode(column, "utf-8")))


def unpacked_key(packed: str | Column) -> Column:
    """The surrogate that ``packed_key`` was given."""
    column = F.col(packed) if isinstance(packed, str) else packed
    rest = F.substring(column, 2, 2**31 - 1)
    is_digest = F.substring(column, 1, 1) == F.lit(b"\x01")
    return F.when(is_digest, F.lower(F.hex(rest))).otherwise(F.decode(rest, "utf-8"))


def packed_number(key: str | Column) -> Column:
    """Text as bytes: a whole number as in "120" in binary, other text as it is; a byte in front tells
    which. Equal where the texts are."""
    column = F.col(key) if isinstance(key, str) else key
    number = column.try_cast("bigint")
    plain = (number >= 0) & (number.cast("string") == column)
    binary = F.concat(F.lit(b"\x01"), F.unhex(F.hex(number)))
    return F.when(plain, binary).otherwise(F.concat(F.lit(b"\x00"), F.encode(column, "utf-8")))


def unpacked_number(packed: str | Column) -> Column:
    """The text that ``packed_number`` was given."""
    column = F.col(packed) if isinstance(packed, str) else packed
    rest = F.substring(column, 2, 2**31 - 1)
    is_number = F.substring(column, 1, 1) == F.lit(b"\x01")
    return F.when(is_number, F.conv(F.hex(rest), 16, 10)).otherwise(F.decode(rest, "utf-8"))


def pack(rows: DataFrame, bits: Mapping[str, int], into: str) -> DataFrame:
    """Put columns of numbers or dates side by side into one bigint, which a shuffle carries in fewer bytes.

    ``bits`` is the width of each, 63 in all at most. A row with a value that does not fit, is negative
    or NULL keeps its values and has NULL in ``into``; the others have NULL in these columns. So equal
    rows stay equal. Columns of other types are left alone. ``unpack`` takes the same ``bits``.
    """
    fields = _fields(rows, bits)
    if not fields:
        return rows.withColumn(into, F.lit(None).cast("bigint"))
    whole = {}
    for name, (kind, _, _) in fields.items():
        value = F.unix_date(name) if isinstance(kind, DateType) else F.col(name)
        if isinstance(kind, DecimalType):
            value = value * F.lit(10**kind.scale).cast(f"decimal({kind.scale + 1},0)")
        whole[name] = value.try_cast("bigint")
    fits = reduce(Column.__and__, [whole[n].between(0, 2**width - 1) for n, (_, width, _) in fields.items()])
    together = reduce(Column.bitwiseOR, [F.shiftleft(whole[n], at) for n, (_, _, at) in fields.items()])
    kept = {n: F.when(F.coalesce(fits, F.lit(False)), F.lit(None)).otherwise(F.col(n)) for n in fields}
    return rows.withColumns({into: F.when(fits, together), **kept})


def unpack(rows: DataFrame, bits: Mapping[str, int], into: str) -> DataFrame:
    """The rows that ``pack`` was given."""
    columns = {}
    for name, (kind, width, at) in _fields(rows, bits).items():
        value = F.shiftright(into, at).bitwiseAND(F.lit(2**width - 1))
        if isinstance(kind, DateType):
            value = F.date_from_unix_date(value.cast("int"))
        elif isinstance(kind, DecimalType):
            value = value.cast("decimal(19,0)") * F.lit(Decimal(1).scaleb(-kind.scale)).cast(f"decimal({kind.scale + 1},{kind.scale})")
        columns[name] = F.when(F.col(into).isNotNull(), value.cast(kind)).otherwise(F.col(name))
    return rows.withColumns(columns).drop(into)


def _fields(rows: DataFrame, bits: Mapping[str, int]) -> dict[str, tuple]:
    """Type, width and place of the columns that can be packed."""
    fields, at = {}, 0
    for name, width in bits.items():
        kind = rows.schema[name].dataType
        if isinstance(kind, DecimalType) and kind.precision + kind.scale > 36:
            continue  # their product with 10**scale could overflow
        if isinstance(kind, DecimalType | IntegralType | DateType):
            fields[name] = (kind, width, at)
            at += width
    return fields


def date_key(ts: str | Column) -> Column:
    """Integer ``yyyyMMdd``, from the date fields rather than through text."""
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def key_date(key: str | Column) -> Column:
    """Date of an integer ``yyyyMMdd``; NULL for a number that is no date."""
    column = F.col(key) if isinstance(key, str) else key
    return F.try_to_date(column.cast("string"), "yyyyMMdd")


def epoch_ms_to_ts(column: Column) -> Column:
    """Text or number of epoch milliseconds → timestamp without zone; malformed → NULL.

    Interval arithmetic keeps the result independent of the session time zone.
    """
    ms = column.try_cast("bigint")
    in_range = ms.between(*_EPOCH_MS_RANGE)
    seconds = (F.when(in_range, ms).cast("decimal(18,0)") / F.lit(1000)).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=seconds)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division, NULL for a zero divisor."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def exact_mean(column: str | Column) -> Column:
    """Mean through an exact sum (decimal or integer), divided once at the end."""
    return ratio(F.sum(column), F.count(column))


def rate(condition: Column) -> Column:
    """Share of the group's rows that meet the condition; NULL counts as not met."""
    return F.avg(F.when(condition, F.lit(1)).otherwise(F.lit(0)))


def any_changed(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """True when any pair differs, NULL being a value like any other."""
    changed = F.lit(False)
    for a, b in zip(left, right, strict=True):
        changed = changed | ~a.eqNullSafe(b)
    return changed
