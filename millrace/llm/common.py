"""What several operators share: tables, column names, written tables, components."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import shared_dir

# ASCII white space, the separators of plain words: [\x20\x09-\x0D].
BLANKS = r"[\x20\x09-\x0D]"
# Separators of alphanumeric words after lower-casing A-Z; other bytes than ASCII belong to words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
# bytes.translate table: A-Z to a-z, separators to blanks. Offsets stay as they are.
FOLD = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 32
    for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` doesn't have, made from ``names``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    """The column of exactly that name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def release_memory() -> None:
    """Give freed memory back to the system. Python workers outlive their tasks, and would keep
    what their largest task needed; called where a task of much memory ends."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with ``value`` as a column that later filters read and do not recompute.

    A filter is otherwise moved below a projection by writing the column's expression, and all
    that it is made of, into the filter once more. It is not moved below a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def text_of(name: str) -> Column:
    return F.coalesce(col(name).cast("string"), F.lit(""))


def text_key(text: Column) -> Column:
    """16 bytes that stand for a text: results that depend on the text only are joined by it."""
    return F.unhex(F.md5(text))


def written(df: DataFrame, purpose: str, partition_by: str | None = None) -> DataFrame:
    """``df``, stored in the shared folder and read again: lineage ends there, work is not repeated."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Bits of a key mask for every key, and at most: beyond that it lets more rows through.
MASK_BITS, MOST_MASK_BITS = 16, 1 << 28


def may_be_in(keys: DataFrame, key: str) -> Callable[[Column], Column]:
    """A test of a column: true for every key of ``keys``, and for some one in 16 of the others.

    So rows of long texts that a join would not find are told apart before they are shuffled for it.
    What is sent to tasks are two bytes a key, 32 MB at most.
    """
    bits = MASK_BITS * max(4, keys.count())
    bits = min(MOST_MASK_BITS, 1 << (bits - 1).bit_length())
    place = keys.select(F.pmod(F.xxhash64(col(key)), F.lit(bits)).alias("place"))
    words = place.groupBy(F.expr("place div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(place % 64 AS int)))").alias("held"))
    found = words.toPandas()
    mask = np.zeros(bits // 64, dtype=np.uint64)
    mask[found["word"].to_numpy(dtype=np.int64)] = found["held"].to_numpy(dtype=np.int64).view(np.uint64)

    @F.pandas_udf("boolean")
    def test(places: pd.Series) -> pd.Series:
        at = places.to_numpy(dtype=np.int64)
        return pd.Series(mask[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1) == 1)

    return lambda column: test(F.pmod(F.xxhash64(column), F.lit(bits)))


class Scratch:
    """Intermediate tables of one operator in the shared folder, given back when they are done with.

    A table may be freed once all that is computed from it is stored; the operator knows when.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    def store(self, df: DataFrame, purpose: str) -> DataFrame:
        path = shared_dir(self.spark, purpose)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = (out, path)
        return out

    def free(self, *tables: DataFrame) -> None:
        for table in tables:
            _, path = self._paths.pop(id(table))
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        # Spark removes shuffle files when the driver's collector finds that their jobs are gone,
        # which a driver with memory to spare does late.
        self.spark._jvm.System.gc()

    def free_all_but(self, *tables: DataFrame) -> None:
        kept = {id(t) for t in tables}
        self.free(*[t for key, (t, _) in list(self._paths.items()) if key not in kept])


def _without(raw: bytes, spans) -> bytes:
    at, parts = 0, []
    for span in spans:
        parts.append(raw[at : span["start"]])
        at = span["end"]
    return b"".join([*parts, raw[at:]])


def cut_bytes(text: Column, spans: Column) -> Column:
    """UTF-8 bytes of ``text`` without the byte ``spans`` (start, end), which are in order."""

    @F.pandas_udf("binary")
    def without(texts: pd.Series, cuts: pd.Series) -> pd.Series:
        pairs = zip(texts, cuts, strict=True)
        return pd.Series([_without(t.encode("utf-8", "surrogatepass"), s) for t, s in pairs], dtype=object)

    return without(text, spans)


def cut(text: Column, spans: Column) -> Column:
    """The same as a string; parts of characters that a cut leaves go with it."""

    @F.pandas_udf("string")
    def without(texts: pd.Series, cuts: pd.Series) -> pd.Series:
        pairs = zip(texts, cuts, strict=True)
        kept = [_without(t.encode("utf-8", "surrogatepass"), s) if len(s) else t.encode() for t, s in pairs]
        return pd.Series([k.decode("utf-8", "ignore") for k in kept], dtype=object)

    return without(text, spans)


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("dst"), F.col("src"))).toDF("u", "v")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (src, dst: long): rows (node, root), root the smallest node.

    Alternates large-star and small-star steps, so the rounds grow with the logarithm of a
    component's size, and a round's rows never outnumber the edges before it plus the nodes.
    Every round is written to the shared folder; a lost executor costs no more than its round.
    Nodes without an edge to another node are not in the result. No edges: no rows.
    """
    scratch = Scratch(edges.sparkSession)
    edges = scratch.store(edges.where("src <> dst").distinct(), "edges")
    before = None
    for _ in range(rounds):
        arcs = _both_ways(edges)
        lowest = arcs.groupBy("u").agg(F.min("v").alias("m"))
        lowest = lowest.select("u", F.least("u", "m").alias("m"))
        large = arcs.where("v > u").join(lowest, "u").select(F.col("v").alias("src"), F.col("m").alias("dst"))
        large = large.where("src <> dst").distinct()
        down = large.select(
            F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")
        )
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u")
        star = (
            small.select(F.col("v").alias("src"), F.col("m").alias("dst"))
            .union(least.select("u", "m"))
            .where("src <> dst")
            .distinct()
        )
        earlier, edges = edges, scratch.store(star, "edges")
        scratch.free(earlier)
        now = tuple(
            edges.agg(
                F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))
            ).first()
        )
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("root")).union(
        edges.select("dst", "dst").distinct()
    )
