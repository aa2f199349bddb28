"""Near copies by SimHash, each link checked by the exact Jaccard similarity of word shingles.

SimHash fingerprints of the same shingles are linked at a few differing bits (``simhash.links``);
of each text's links a few are checked on the whole sets. That finds close copies, and dissolves large
groups of them. Copies of similarity 0.8 may differ in more bits than SimHash can link, so the check is
completed over prefixes: shingles have one order, rare ones by hash, then common ones by hash. Two sets
of similarity 0.8 or more share a shingle among the first n // 5 + 1 of each, whatever the order is; so a
join on these finds every pair that isn't connected yet. What stands before the first shared shingle is in
one set only, so that a pair needs a shingle early enough in both for what is left to suffice; most sets
that share but what is common lie too far behind in each other's groups. While that would be many pairs,
in rounds, every set is first compared with a few pivots of its prefix groups only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import simhash
from millrace.llm.common import Scratch, col, components, fresh, may_be_in, release_memory, text_key, text_of, written
from millrace.llm.simhash import shingle_hashes

SIZE = 5  # words of a shingle
SEED = 42
SAMPLE = 16  # one text of so many is counted to find common shingles
COMMON_SHARE = 2000  # a shingle is common if more than one sampled text in so many has it
COMMON_LEAST = 20
DISTANCE = 4  # differing bits of linked fingerprints
PIVOTS = 3  # of each prefix shingle, in a round; of each fingerprint's links
ROUNDS = 4  # at most, of fingerprints and then of pivots, before what is left is paired
SKETCH = 1024  # bits of a set's sketch, at least
FEW_PAIRS = 2  # for each prefix shingle of a set, up to which what is left is paired at once


def shingle_set(text: str, size: int = SIZE) -> np.ndarray:
    """Distinct shingle hashes of a text, in order; a text of fewer words is one shingle."""
    return _distinct(list(shingle_hashes(text, size, SEED)))


def _distinct(blocks: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(blocks)) if blocks else np.zeros(0, dtype=np.uint64)


def is_near(a: Column, b: Column, common: Column) -> Column:
    """Whether sets of ``a`` and ``b`` members with ``common`` shared ones have similarity 4/5 or more."""
    return 9 * common >= 4 * (a + b)


def sketch(members: np.ndarray) -> np.ndarray:
    """Bits, each whether an odd number of the set's members falls on it. What two sets share cancels
    out: at most as many bits differ as there are members that only one of the sets has.

    A power of two of bits, no fewer than members: sets that are much unlike differ in up to half of the
    bits, which must be more than a ninth of both sets' members to tell them apart."""
    bits = max(SKETCH, 1 << (max(1, len(members)) - 1).bit_length())
    odd = np.bincount((members >> np.uint64(32)).astype(np.int64) % bits, minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _folded(own: Column, other: Column) -> Column:
    """A sketch in half its bits if it has twice as many as ``other``."""
    half = F.size(other)
    return F.when(F.size(own) > half, F.zip_with(F.slice(own, F.lit(1), half), F.slice(own, half + 1, half), lambda x, y: x.bitwiseXOR(y))).otherwise(own)


def differing(a: Column, b: Column) -> Column:
    """In how many bits the sketches of sets differ whose sizes differ by a factor of two at most."""
    both = F.zip_with(_folded(a, b), _folded(b, a), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(both, F.lit(0), lambda x, y: x + y)


def _set_column(texts: DataFrame, size: int, key: str) -> DataFrame:
    """(key, shingles) of (key, text)."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k in range(0, len(batch), 500):
                part = batch[k : k + 500]
                sets = [shingle_set(t, size).view(np.int64) for t in part["text"]]
                yield pd.DataFrame({key: part[key].to_numpy(), "shingles": sets})
        release_memory()

    return texts.select(key, "text").mapInPandas(work, f"{key} {dict(texts.dtypes)[key]}, shingles array<long>")


def common_shingles(texts: DataFrame, size: int, scratch: Scratch) -> np.ndarray:
    """Hashes, in order, of shingles that many texts of a sample have. They only change the order
    of prefixes, so a shingle missed here costs candidates and no result."""
    chosen = texts.where(F.pmod(F.xxhash64("text_key"), F.lit(SAMPLE)) == 0).dropDuplicates(["text_key"])
    sets = scratch.store(_set_column(chosen, size, "text_key"), "sample")
    least = max(COMMON_LEAST, sets.count() // COMMON_SHARE)
    counts = sets.select(F.explode("shingles").alias("key")).groupBy("key").count()
    rows = counts.where(F.col("count") > least).select("key").toPandas()["key"]
    scratch.free(sets)
    return np.sort(rows.to_numpy(dtype=np.int64).view(np.uint64))


def _with_prefix(texts: DataFrame, common: np.ndarray, size: int) -> DataFrame:
    """(text_key, doc_id, node, fp, n, prefix, sketch): node is a 64-bit hash of the whole set."""
    import xxhash

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            nodes, prints, sizes, prefixes, sketches = [], [], [], [], []
            for text in batch["text"]:
                blocks = list(shingle_hashes(text, size, SEED))
                prints.append(simhash.fingerprint_of_hashes(blocks))
                own = _distinct(blocks)
                last = np.isin(own, common, assume_unique=True)
                order = np.concatenate((own[~last], own[last]))
                nodes.append(xxhash.xxh3_64_intdigest(own.tobytes()))
                sizes.append(len(own))
                prefixes.append(order[: len(own) // 5 + 1].view(np.int64))
                sketches.append(sketch(own))
            out = batch.drop(columns="text")
            out["node"] = np.array(nodes, dtype=np.uint64).view(np.int64)
            out["fp"] = np.array(prints, dtype=np.uint64).view(np.int64)
            out["n"], out["prefix"], out["sketch"] = sizes, prefixes, sketches
            yield out
        release_memory()

    columns = "doc_id string, text_key binary, node long, fp long, n int, prefix array<long>, sketch array<long>"
    return texts.mapInPandas(work, columns)


def _verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, size: int, scratch: Scratch) -> DataFrame:
    """Of ``pairs`` (a, b) those whose whole sets are near, as (src, dst)."""
    # Most pairs are told apart by sketches, before their sets are shuffled.
    for end in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("node").alias(end), F.col("n").alias(f"n{end}"), F.col("sketch").alias(f"s{end}")), end)
    sizes = is_near(F.col("na"), F.col("nb"), F.least("na", "nb"))
    pairs = pairs.where(sizes & (F.col("na") + F.col("nb") >= 9 * differing(F.col("sa"), F.col("sb"))))
    pairs = scratch.store(pairs.select("a", "b"), "pairs")
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = scratch.store(nodes.drop("n", "sketch").join(ends, "node"), "wanted")
    # One row of each text, found by its first id; only rows equal in id and text are told apart by a shuffle.
    own = wanted.select("node", F.col("text_key").alias("own_key"), F.col("doc_id").alias("first_id"), "several")
    chosen = texts.where(may_be_in(wanted, "text_key")(F.col("text_key")))
    same = chosen.join(own, F.expr("text_key = own_key AND doc_id <=> first_id"))
    found = same.select("node", "text")
    if not wanted.where("several").isEmpty():
        found = same.where("NOT several").select("node", "text")
        found = found.union(same.where("several").select("node", "text").dropDuplicates(["node"]))
    sets = scratch.store(_set_column(found, size, "node"), "sets")
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    near = pairs.join(a, "a").join(b, "b").where(is_near(F.size("sa"), F.size("sb"), both))
    near = scratch.store(near.select(F.col("a").alias("src"), F.col("b").alias("dst")), "near")
    scratch.free(pairs, wanted, sets)
    return near


def _may_be_near(n: Column, left: Column, m: Column, left_m: Column) -> Column:
    """Of sets of ``n`` and ``m`` members that share one which is among the last ``left`` and ``left_m``.

    All that they share is among the last of both from their first shared member on. So near sets pass by
    that one, if by no other; sizes that differ by over a fifth never do."""
    return is_near(n, m, F.least(left, left_m))


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """(doc_id as a string, text_key, root) for every row of ``docs``, repeated rows included.

    Rows whose sets of ``size``-word shingles have a Jaccard similarity of 0.8 or more are linked;
    rows with one root are connected over links. Words are those of SimHash. Equal sets are one;
    texts without words are linked to each other only. Shingles and sets are told apart by
    64-bit hashes. Empty input: no rows.
    """
    own = docs.select(
        col(doc_id).cast("string").alias("doc_id"), text_key(text_of(text)).alias("text_key"), text_of(text).alias("text")
    )
    texts = own.select("doc_id", "text_key", "text")
    scratch = Scratch(docs.sparkSession)
    prints = scratch.store(_with_prefix(own, common_shingles(texts, size, scratch), size), "prints")
    one = prints.groupBy("node").agg(F.first(F.struct("text_key", "fp", "n", "prefix", "sketch")).alias("p"))
    classes = scratch.store(one.select("node", "p.*"), "classes")
    rows = scratch.store(prints.select("doc_id", "text_key", "node"), "rows")
    nodes = scratch.store(_first_rows(rows, classes.select("node", "text_key", "n", "sketch")), "nodes")
    scratch.free(prints)

    near = _verified(_by_fingerprint(classes.select("node", "fp")), nodes, texts, size, scratch)
    roots = scratch.store(components(near), "roots")
    # Stored, so that the joins are between plain shuffles, and hot keys can be split.
    members = scratch.store(_unconnected(_keyed(_rooted(classes.select("node", "n", "prefix"), roots)), scratch), "members")
    for number in range(1, ROUNDS):
        if _pairs_left(members) <= FEW_PAIRS * members.count():
            break
        links = _verified(_to_pivots(members, number), nodes, texts, size, scratch)
        new = links.count()
        roots = scratch.store(components(_stars(roots).union(links)), "roots")
        # Sets are given their roots before they are spread over their keys, and only those that still have any.
        left = classes.select("node", "n", "prefix").join(members.select("node").distinct(), "node", "left_semi")
        left = scratch.store(_rooted(left, roots), "left")
        before, members = members, scratch.store(_unconnected(_keyed(left), scratch), "members")
        scratch.free(before, left)
        # A round that links little: what is left is not near its groups' members.
        if new * 100 <= members.agg(F.count_distinct("node")).first()[0]:
            break

    scratch.free(classes)

    # All pairs that share a key and are not connected yet.
    sides = members.groupBy("key", "root").agg(F.max("n").alias("most"), F.min("n").alias("fewest"), F.max("left").alias("left"))
    sides = scratch.store(sides, "sides")
    x, y = sides.alias("x"), sides.alias("y")
    on = (F.col("x.key") == F.col("y.key")) & (F.col("x.root") < F.col("y.root"))
    # Sizes of near sets differ by a fifth at most.
    on = on & (5 * F.col("x.most") >= 4 * F.col("y.fewest")) & (5 * F.col("y.most") >= 4 * F.col("x.fewest"))
    on = on & _may_be_near(F.col("x.fewest"), F.col("x.left"), F.col("y.fewest"), F.col("y.left"))
    across = scratch.store(x.join(y, on).select("x.key", F.col("x.root").alias("ra"), F.col("y.root").alias("rb")), "across")
    a = members.select("key", F.col("root").alias("ra"), F.col("node").alias("a"), F.col("n").alias("na"), F.col("left").alias("la"))
    b = members.select("key", F.col("root").alias("rb"), F.col("node").alias("b"), F.col("n").alias("nb"), F.col("left").alias("lb"))
    early = _may_be_near(F.col("na"), F.col("la"), F.col("nb"), F.col("lb"))
    pairs = across.join(a, ["key", "ra"]).join(b, ["key", "rb"]).where(early).select("a", "b").distinct()
    more = _verified(pairs, nodes, texts, size, scratch)
    roots = components(_stars(roots).union(more))
    found = rows.join(roots, "node", "left")
    found = scratch.store(found.select("doc_id", "text_key", F.coalesce("root", "node").alias("root")), "found")
    scratch.free_all_but(found)
    return found


def _first_rows(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``nodes`` with (doc_id, several): the first id that a node's text has, and whether it has it twice."""
    same = rows.join(nodes.select("text_key"), "text_key", "left_semi").groupBy("text_key", "doc_id").agg(F.count("*").alias("rows"))
    place = F.struct((F.col("rows") > 1).alias("several"), "doc_id")
    first = same.groupBy("text_key").agg(F.min(place).alias("f"))
    return nodes.join(first.select("text_key", "f.doc_id", "f.several"), "text_key")


def _by_fingerprint(prints: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets whose SimHash fingerprints are linked: for each fingerprint PIVOTS of its
    links at most, and one set for all that have it. Neighbours in a dense group choose alike."""
    first = prints.groupBy("fp").agg(F.min("node").alias("first"))
    equal = prints.join(first, "fp").where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    links = simhash.links(prints, DISTANCE)
    # By masks, as the least of longs needs no sort; a mask undone gives the fingerprint.
    masks = (0x2545F4914F6CDD1D, 0x5851F42D4C957F2D, 0x14057B7EF767814F)[:PIVOTS]
    least = links.groupBy("b").agg(*[F.min(F.col("a").bitwiseXOR(F.lit(m))).alias(f"p{k}") for k, m in enumerate(masks)])
    chosen = F.array_distinct(F.array(*[F.col(f"p{k}").bitwiseXOR(F.lit(m)) for k, m in enumerate(masks)]))
    pairs = least.select(F.col("b").alias("fp"), F.explode(chosen).alias("other"))
    pairs = pairs.join(first, "fp").select("other", F.col("first").alias("a"))
    pairs = pairs.join(first.withColumnRenamed("fp", "other"), "other").select("a", F.col("first").alias("b"))
    return equal.union(pairs)


def _rooted(sets: DataFrame, roots: DataFrame) -> DataFrame:
    """``sets`` with the root of each node so far."""
    return sets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _stars(roots: DataFrame) -> DataFrame:
    """Links that connect what ``roots`` connects."""
    return roots.select(F.col("node").alias("src"), F.col("root").alias("dst"))


def _keyed(sets: DataFrame) -> DataFrame:
    """A row for each shingle in the prefix of a set; left: members from that one on."""
    keys = sets.select("node", "n", "root", F.posexplode("prefix").alias("at", "key"))
    return keys.select("node", "n", "root", "key", (F.col("n") - F.col("at")).alias("left"))


def _unconnected(keys: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows of ``keys`` whose key may join near sets that are not connected."""
    # The least set of the key, and a set that is less by a fifth, are the least that any may be near to.
    ends = [F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("n").alias("fewest")]
    early = 9 * F.col("left") >= 4 * (F.col("n") + F.greatest("fewest", F.ceil(4 * F.col("n") / 5)))
    mixed = scratch.store(keys.groupBy("key").agg(*ends).where("lo <> hi").select("key", "fewest"), "mixed")
    return keys.join(mixed, "key").where(early).drop("fewest")


def _pairs_left(members: DataFrame) -> int:
    """About how many pairs of unconnected groups share a key early enough, each key by itself.

    Groups of about one size and place in the key are counted as one, so that no pairs are made for it."""
    sides = members.groupBy("key", "root").agg(F.avg("n").alias("n"), F.max("left").alias("left"))
    like = [F.round(8 * F.log2("n")).alias("size"), F.floor(36 * (1 - F.col("left") / F.col("n"))).alias("place")]
    kinds = sides.groupBy("key", *like).agg(F.avg("n").alias("n"), F.avg("left").alias("left"), F.count("*").alias("g"))
    x, y = kinds.alias("x"), kinds.alias("y")
    own = (F.col("x.size") == F.col("y.size")) & (F.col("x.place") == F.col("y.place"))
    near = (F.col("x.key") == F.col("y.key")) & _may_be_near(F.col("x.n"), F.col("x.left"), F.col("y.n"), F.col("y.left"))
    met = F.col("x.g").cast("decimal(38,0)") * (F.col("y.g") - own.cast("int"))
    return int(x.join(y, near).agg(F.sum(met)).first()[0] or 0) // 2


def _to_pivots(members: DataFrame, number: int) -> DataFrame:
    """Pairs (a, b) of a set and a pivot of its keys, PIVOTS at most for a set: those that share
    the most early keys of what may be near and is not connected. Rounds have unlike pivots."""
    salts = [number * PIVOTS + k for k in range(PIVOTS)]
    # One has the key earliest, so that it has little which the others of a group of copies don't have.
    rest = [F.lit(0), F.lit(0), F.col("left") - F.col("n")][-PIVOTS:]
    pivots = [F.max(F.struct(r.alias("rest"), F.xxhash64("node", F.lit(s)).alias("turn"), "node", "n", "root", "left")) for r, s in zip(rest, salts, strict=True)]
    chosen = members.groupBy("key").agg(F.array_distinct(F.array(*pivots)).alias("pivots"))
    met = members.join(chosen, "key").select("node", "n", "root", "left", F.explode("pivots").alias("p"))
    # Told before the pairs are shuffled.
    met = met.where((F.col("root") != F.col("p.root")) & _may_be_near(F.col("n"), F.col("left"), F.col("p.n"), F.col("p.left")))
    met = met.groupBy("node", F.col("p.node").alias("pivot")).agg(F.count("*").alias("c"))
    best = met.groupBy("node").agg(F.slice(F.sort_array(F.collect_list(F.struct("c", "pivot")), False), 1, PIVOTS).alias("best"))
    return best.select(F.col("node").alias("a"), F.explode("best.pivot").alias("b"))


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """One row of each group of near copies: that with the smallest doc_id; same columns.

    A null doc_id comes last; of unlike texts under one id each is judged by itself, and of several
    near copies under the smallest id the one with the least text digest stays. Only rows equal
    in id and text stand for each other. The row kept is the same for any order of the input.
    """
    kind = docs.select(col(doc_id)).schema[0].dataType
    found = near_copies(docs, doc_id, text, size).withColumn("doc_id", F.col("doc_id").cast(kind))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    own_id, own_key, own_rows, rank = fresh(docs, "own_id", "own_key", "own_rows", "rank")
    # Rows equal in id and text are told apart only where one of them stays.
    same = found.groupBy("root", "doc_id", "text_key").agg(F.count("*").alias("rows"))
    kept = same.groupBy("root").agg(F.min(place).alias("k"))
    marked = same.join(kept, "root").withColumn("stays", place == F.col("k"))
    special = marked.where("NOT stays OR rows > 1")
    special = written(
        special.select(
            F.col("doc_id").alias(own_id), F.col("text_key").alias(own_key), F.when(F.col("stays"), F.col("rows")).otherwise(0).alias(own_rows)
        ),
        "special",
    )
    columns = [col(c) for c in docs.columns]
    left = docs.withColumn(own_key, text_key(text_of(text)))
    marked = may_be_in(special, own_key)(F.col(own_key))
    other = special.withColumnRenamed(own_key, f"{own_key}_")
    on = (F.col(own_key) == F.col(f"{own_key}_")) & col(doc_id).eqNullSafe(other[own_id])
    joined = left.where(marked).join(other, on, "left")
    kept = left.where(~marked).select(*columns).union(joined.where(F.col(own_rows).isNull()).select(*columns))
    if special.where(F.col(own_rows) > 1).isEmpty():
        return kept
    order = Window.partitionBy(col(doc_id), F.col(own_key)).orderBy(F.lit(1))
    first = joined.where(F.col(own_rows) > 1).withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1)
    return kept.union(first.select(*columns))
