"""WARC archives and their fixity: Merkle trees over records and ordered offset ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import col, fresh, written


def warc_records(pages: DataFrame, archives: int, page_id: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """(archive, record_id, offset, length, block): pages as WARC response records.

    Records are dealt to ``archives`` files by a hash of id and url, so that neither a hot host
    nor a hot url makes a file large, and follow each other by id. offset is where the record
    begins in its file; null bodies are empty, null urls and ids are written as "-". Rows equal in
    every column are separate records. The record's header and block are made by built-in functions.
    """
    (ident, where) = (F.coalesce(col(page_id).cast("string"), F.lit("-")), F.coalesce(col(url), F.lit("-")))
    content = F.coalesce(col(body), F.lit(""))
    df = pages.select(
        F.pmod(F.xxhash64(ident, where), F.lit(archives)).cast("int").alias("archive"),
        col(page_id).alias("record_id"),
        F.concat(
            F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
            ident,
            F.lit(">\r\nWARC-Target-URI: "),
            where,
            F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
            F.octet_length(content).cast("string"),
            F.lit("\r\n\r\n"),
            content,
            F.lit("\r\n\r\n"),
        ).alias("block"),
    )
    df = df.withColumn("length", F.octet_length("block").cast("long"))
    order = Window.partitionBy("archive").orderBy("record_id", F.md5("block"))
    end = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn("offset", end - F.col("length")).select("archive", "record_id", "offset", "length", "block")


def record_hashes(records: DataFrame) -> DataFrame:
    """The trees' leaves: (archive, offset, record_id, length, digest). Hash and place of each record."""
    return records.select(
        "archive", "offset", "record_id", "length", F.unhex(F.sha2(F.col("block").cast("binary"), 256)).alias("digest")
    )


def _node(parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(F.lit(b""), F.array_join(F.transform(parts, lambda p: F.hex(p["digest"])), "").cast("binary")), 256))


def tree(leaves: DataFrame, range_bytes: int = 1 << 16, fanout: int = 16, archive_bytes: int = 1 << 30) -> list[DataFrame]:
    """Levels (archive, node, digest), lowest first, of each archive's Merkle tree.

    Node k of level 0 covers the records that begin in the k-th ``range_bytes`` of the file, by
    offset; a node of a higher level covers ``fanout`` nodes of the one below. The number of levels
    follows from ``archive_bytes``, the largest file expected; a larger file has a few more
    children under its root, nothing else. A node hashes its children in order, with their places.
    """
    own = F.struct("offset", F.unhex(F.sha2(F.concat(F.col("offset").cast("string").cast("binary"), F.col("digest")), 256)).alias("digest"))
    level = leaves.groupBy("archive", F.expr(f"offset div {range_bytes}").alias("node")).agg(
        _node(F.array_sort(F.collect_list(own))).alias("digest")
    )
    levels, width = [level], range_bytes
    while width < archive_bytes:
        width *= fanout
        child = F.struct("node", "digest")
        level = level.groupBy("archive", F.expr(f"node div {fanout}").alias("parent")).agg(
            _node(F.array_sort(F.collect_list(child))).alias("digest")
        )
        level = level.withColumnRenamed("parent", "node")
        levels.append(level)
    return levels


def _differing(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose digests differ or that only one side has."""
    a = a.select(*keys, F.col("digest").alias("a"))
    b = b.select(*keys, F.col("digest").alias("b"))
    return a.join(b, keys, "full").where(~F.col("a").eqNullSafe(F.col("b"))).select(*keys)


def audit(original: DataFrame, replica: DataFrame, fanout: int = 16, **options) -> DataFrame:
    """Records on which two copies of archives disagree, found by descending differing branches.

    Both inputs are leaves, as record_hashes gives. Rows: archive, offset, original_id,
    replica_id, original_digest, replica_digest, status. status is "corrupt" (both copies have a
    record at that offset, the hashes differ), "missing" or "added" (only the original, or only
    the replica, has one there). From the roots down, only children of differing nodes are
    compared. Copies that agree give no rows, as do two empty inputs. Of several records at one
    offset, which a sound file can't have, those with a hash that both copies have are left out.
    """
    a, b = (written(x, "leaves") for x in (original, replica))
    up, down = tree(a, fanout=fanout, **options), tree(b, fanout=fanout, **options)
    up, down = ([written(x, "nodes") for x in levels] for levels in (up, down))
    # Stored level by level: each is read for both copies, and plans would double with every level.
    differing = written(_differing(up[-1], down[-1], ["archive", "node"]), "differing")
    for own, other in zip(reversed(up[:-1]), reversed(down[:-1]), strict=True):
        parents = differing.select("archive", F.col("node").alias("parent"))
        inside = [
            x.withColumn("parent", F.expr(f"node div {fanout}")).join(parents, ["archive", "parent"], "left_semi")
            for x in (own, other)
        ]
        differing = written(_differing(*inside, ["archive", "node"]), "differing")
    width = options.get("range_bytes", 1 << 16)
    suspect = [
        x.withColumn("node", F.expr(f"offset div {width}")).join(differing, ["archive", "node"], "left_semi")
        for x in (a, b)
    ]
    left, right = (
        written(x.groupBy("archive", "offset", "digest").agg(F.min("record_id").alias("record_id")), "suspect")
        for x in suspect
    )
    only_left = left.join(right, ["archive", "offset", "digest"], "left_anti")
    only_right = right.join(left, ["archive", "offset", "digest"], "left_anti")
    only_left = only_left.select(
        "archive", "offset", F.col("record_id").alias("original_id"), F.hex("digest").alias("original_digest")
    )
    only_right = only_right.select(
        "archive", "offset", F.col("record_id").alias("replica_id"), F.hex("digest").alias("replica_digest")
    )
    status = F.when(F.col("replica_digest").isNull(), "missing").when(F.col("original_digest").isNull(), "added")
    return only_left.join(only_right, ["archive", "offset"], "full").withColumn("status", status.otherwise("corrupt"))


def damaged_copy(records: DataFrame, one_in: int = 500) -> DataFrame:
    """A replica for drills: of one record in ``one_in``, by hash of its id, one byte is changed.

    Lengths and offsets stay. Records of no bytes can't be damaged.
    """
    hit = F.pmod(F.xxhash64(F.col("record_id"), F.lit("drill")), F.lit(one_in)) == 0
    at = F.pmod(F.xxhash64("record_id"), F.col("length") - 4).cast("int") + 1
    (spare,) = fresh(records, "spare")
    changed = F.when(F.substring("block", at, F.lit(1)) == "~", "^").otherwise("~")
    ascii_there = F.octet_length(F.substring("block", at, F.lit(1))) == 1
    block = F.when(hit & ascii_there, F.overlay("block", changed, at, F.lit(1)))
    return records.withColumn("block", F.coalesce(block, F.col("block"))).drop(spare)


def archives_for(records: DataFrame, body: str = "html", archive_bytes: int = 1 << 30) -> int:
    """How many files keep each near ``archive_bytes``; at least 8, to spread the work."""
    total = records.agg(F.sum(F.octet_length(col(body)))).first()[0] or 0
    return max(8, -(-int(total) // archive_bytes))
