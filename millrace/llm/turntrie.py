"""Prefix trie of conversations from padded matrices of turn ids.

Conversations are dealt by range of their turn ids, so a task holds neighbours. It pads their ids
to a matrix, sorts the rows by ``lexsort``, and marks where a column differs from the row above;
OR-accumulated along the row, the marks say at which depths a node starts. ``reduceat`` over these
starts sums members, children, leaves and saved text of every depth.

Nodes on the path of a task's first or last row may go on in other tasks. Of those only the two
paths leave the task, with their sums; the same routine over all such paths puts them together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import col, release_memory, text_of, written

PANEL = 64  # columns of the matrix that are in memory at once
IDS_PER_ROW = 500  # conversation ids in one row of an open node's list
NO_ID = np.iinfo(np.int64).max  # stands for a null conv_id, so that it is never the smallest


# --- conversations as lists of turn ids ---


def turn_id(role: Column, text: Column) -> Column:
    """16 bytes that stand for a turn."""
    return F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))


def conversation_paths(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, family, turns): one row per conversation, its turns (turn, id, chars) in order.

    Turns are ordered by ``turn``, null first; where that ties, by their ids. A null role or text is
    empty. Repeated rows are repeated turns. Rows without a conv_id are one conversation.
    ``family`` is conv_id - conv_id % 100; rows are dealt by it.
    """
    c = col(conv_id).cast("long")
    turns = rows.select(
        c.alias("conv_id"),
        (c - c % 100).alias("family"),
        F.struct(col(turn).alias("turn"), turn_id(text_of(role), text_of(text)).alias("id"), F.length(text_of(text)).alias("chars")).alias("t"),
    )
    # Dealt by family, which the grouping by conversation and the window after it can both use.
    return turns.repartition("family").groupBy("family", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(paths: DataFrame, most: int = 6) -> DataFrame:
    """(conv_id, ids, chars): each conversation c as the first h turns of the conversation
    c - c % 100 and then its own turns after its first h, h being the unsigned CRC-32 of decimal c
    modulo ``most``. Without that conversation there are none of its turns. A null c stays as it is."""
    own = F.when(F.col("conv_id") == F.col("family"), F.slice("turns", 1, most - 1))
    first = F.first(own, ignorenulls=True).over(Window.partitionBy("family"))
    h = F.coalesce((F.crc32(F.col("conv_id").cast("string")) % most).cast("int"), F.lit(0))
    nothing = F.slice("turns", 1, 0)
    head = F.slice(F.coalesce(first, nothing), F.lit(1), h)
    rest = F.slice("turns", h + 1, F.size("turns"))
    whole = paths.select("conv_id", F.concat(head, rest).alias("turns"))
    return whole.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.chars").alias("chars"))


# --- one shard ---


@dataclass
class Shard:
    """Paths, flat: row i has the cells starts[i] to starts[i + 1] of ``ids`` (ranks of ``raw``).

    ``sums`` are what is known of the nodes on a row's path, for each depth from 0, in cells
    starts[i] + i + depth; without them each row is one conversation.
    """

    conv: np.ndarray
    starts: np.ndarray
    raw: np.ndarray
    ids: np.ndarray
    chars: np.ndarray
    sums: dict[str, np.ndarray] | None = None

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.starts)


def ranks(raw: np.ndarray) -> np.ndarray:
    """Dense numbers of 16-byte ids, in the order of their bytes."""
    halves = raw.view(">u8").reshape(-1, 2)
    order = np.lexsort((halves[:, 1], halves[:, 0]))
    change = np.zeros(len(raw), dtype=np.int64)
    change[1:] = (halves[order[1:]] != halves[order[:-1]]).any(axis=1)
    out = np.empty(len(raw), dtype=np.int64)
    out[order] = np.cumsum(change)
    return out


def panel(shard: Shard, rows: np.ndarray, first: int, width: int) -> np.ndarray:
    """Columns ``first`` and on of the padded matrix, for ``rows``; -1 is padding."""
    at = shard.starts[rows][:, None] + first + np.arange(width)
    inside = first + np.arange(width) < shard.lengths[rows][:, None]
    out = np.full(at.shape, -1, dtype=np.int64)
    out[inside] = shard.ids[at[inside]]
    return out


def sorted_rows(shard: Shard) -> np.ndarray:
    """Rows in the order of their paths, then of their ids; sorted from the last panel to the first."""
    order = np.argsort(shard.conv, kind="stable")
    lengths = shard.lengths
    longest = int(lengths.max(initial=0))
    for first in range((longest - 1) // PANEL * PANEL, -1, -PANEL):
        longer = lengths[order] > first
        rows = order[longer]
        matrix = panel(shard, rows, first, min(PANEL, longest - first))
        order = np.concatenate((order[~longer], rows[np.lexsort(matrix.T[::-1])]))
    return order


def node_starts(shard: Shard, order: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each depth from 0: places (in ``order``) of the rows that are as deep, and which of them
    start a node."""
    lengths = shard.lengths[order]
    yield np.arange(len(order)), np.arange(len(order)) == 0
    longest = int(lengths.max(initial=0))
    differs = np.zeros(len(order), dtype=bool)
    differs[:1] = True
    for first in range(0, longest, PANEL):
        width = min(PANEL, longest - first)
        places = np.flatnonzero(lengths > first)
        matrix = panel(shard, order[places], first, width)
        change = np.ones(matrix.shape, dtype=bool)
        change[1:] = matrix[1:] != matrix[:-1]
        # The row above is missing here if it is shorter; then it differed in an earlier panel.
        marks = np.logical_or.accumulate(change, axis=1)
        above = np.zeros(len(places), dtype=bool)
        above[1:] = places[1:] == places[:-1] + 1
        marks |= (differs[places] | ~above)[:, None]
        for j in range(width):
            deep = lengths[places] > first + j
            yield places[deep], marks[deep, j]
        differs[places] = marks[:, -1]


@dataclass
class Level:
    """Nodes of one depth, in order. ``start``: place of the first row; ``open``: may go on elsewhere."""

    start: np.ndarray
    open: np.ndarray
    n: np.ndarray
    first: np.ndarray
    kids: np.ndarray
    leaves: np.ndarray
    saved: np.ndarray
    parent: np.ndarray


def levels(shard: Shard, order: np.ndarray, edges_open: bool) -> list[Level]:
    """All nodes by depth. With ``edges_open``, nodes of the first and last row are open: their sums
    are of the nodes below them that aren't."""
    n_rows = len(order)
    if not n_rows:
        return []
    marked = list(node_starts(shard, order))
    leaf_at, saved_at, kid_at = (np.zeros(n_rows, dtype=np.int64) for _ in range(3))
    out: list[Level] = []
    for depth in range(len(marked) - 1, -1, -1):
        places, starting = marked[depth]
        begin = np.flatnonzero(starting)
        start = places[begin]
        cells = shard.starts[order[places]] + order[places] + depth

        def total(name: str, column: np.ndarray, begin=begin, cells=cells) -> np.ndarray:
            given = shard.sums[name][cells] if shard.sums else 0
            return np.add.reduceat(column + given, begin)

        conv = shard.sums["first"][cells] if shard.sums else shard.conv[order[places]]
        n = total("n", np.full(len(places), 0 if shard.sums else 1))
        kids = total("kids", kid_at[places])
        last = places[np.append(begin[1:], len(places)) - 1]
        is_open = edges_open & ((start == 0) | (last == n_rows - 1))
        chars = shard.chars[shard.starts[order[start]] + depth - 1] if depth else np.zeros(len(start), dtype=np.int64)
        whole = ~is_open
        leaf_at[start[whole & (kids == 0)]] += 1
        saved_at[start[whole]] += ((n - 1) * chars)[whole]
        level = Level(
            start, is_open, n, np.minimum.reduceat(conv, begin), kids,
            total("leaves", leaf_at[places]), total("saved", saved_at[places]), np.zeros(len(start), dtype=np.int64),
        )
        if out:
            out[-1].parent = np.searchsorted(start, out[-1].start, side="right") - 1
        out.append(level)
        kid_at[:] = 0
        kid_at[start[whole]] = 1
    return out[::-1]


def path_keys(raw: np.ndarray) -> list[bytes]:
    """Digest of every prefix of a path, the empty one first."""
    digest = hashlib.md5()
    keys = [digest.digest()]
    for piece in raw:
        digest.update(piece.tobytes())
        keys.append(digest.digest())
    return keys


# --- what tasks hand on ---

NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long,"
    " saved_tokens long, ends_sha256 string, turn_id binary"
)
FOUND = (
    f"kind string, {NODE}, key binary, ids array<binary>, chars array<int>,"
    " n array<long>, first array<long>, kids array<long>, leaves array<long>, saved array<long>, convs string"
)
SUMS = ("n", "first", "kids", "leaves", "saved")
NOTHING = hashlib.sha256(b"").hexdigest()

_LONGS = pa.list_(pa.int64())
_TYPES = (
    [("kind", pa.string())]
    + [(c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [("ends_sha256", pa.string()), ("turn_id", pa.binary()), ("key", pa.binary()), ("ids", pa.list_(pa.binary())), ("chars", pa.list_(pa.int32()))]
    + [(c, _LONGS) for c in SUMS]
    + [("convs", pa.string())]
)


def _batch(kind: str, rows: int, **columns) -> pa.RecordBatch:
    arrays = []
    for name, kind_of in _TYPES:
        value = [kind] * rows if name == "kind" else columns.get(name)
        if value is None:
            arrays.append(pa.nulls(rows, kind_of))
        else:
            arrays.append(value if isinstance(value, pa.Array) else pa.array(value, kind_of))
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in _TYPES])


def _ids(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64(), mask=values == NO_ID)


def _listed(conv: np.ndarray) -> str:
    return ",".join(map(str, conv[conv != NO_ID].tolist()))


def _shard_of(table: pa.Table) -> Shard:
    lists = table.column("ids").combine_chunks()
    flat = lists.flatten().cast(pa.binary(16))
    raw = np.frombuffer(flat.buffers()[1], dtype="V16")[flat.offset : flat.offset + len(flat)] if len(flat) else np.zeros(0, "V16")
    starts = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64)
    chars = table.column("chars").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sums = None
    conv = np.zeros(len(starts) - 1, dtype=np.int64)
    if "n" in table.column_names:
        sums = {c: table.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in SUMS}
    else:
        conv = table.column("conv_id").combine_chunks().fill_null(NO_ID).to_numpy(zero_copy_only=False)
    return Shard(conv, starts, raw, ranks(raw), chars, sums)


def _last_turns(shard: Shard, order: np.ndarray, start: np.ndarray, depth: int) -> list[bytes | None]:
    if not depth:
        return [None] * len(start)
    return [r.tobytes() for r in shard.raw[shard.starts[order[start]] + depth - 1]]


def _node_batch(shard: Shard, order: np.ndarray, found: list[Level], depth: int, chosen: np.ndarray, **more) -> pa.RecordBatch:
    level = found[depth]
    parents = found[depth - 1].first[level.parent] if depth else np.full(len(level.start), NO_ID)
    return _batch(
        "node",
        int(chosen.sum()),
        conv_id=_ids(level.first[chosen]),
        depth=np.full(int(chosen.sum()), depth),
        n_convs=level.n[chosen],
        n_children=level.kids[chosen],
        n_leaves=level.leaves[chosen],
        saved_tokens=level.saved[chosen],
        turn_id=_last_turns(shard, order, level.start[chosen], depth),
        **{"parent_conv_id": _ids(parents[chosen])} | more,
    )


def shard_nodes(shard: Shard) -> Iterator[pa.RecordBatch]:
    """Whole nodes; the two edge paths with what is known of their nodes; members that end at these."""
    order = sorted_rows(shard)
    found = levels(shard, order, edges_open=True)
    if not found:
        return
    lengths, conv = shard.lengths[order], shard.conv[order]
    paths = [shard.raw[shard.starts[r] : shard.starts[r + 1]] for r in (order[0], order[-1])]
    keys = [path_keys(p) for p in paths]
    edges = [{c: [] for c in SUMS} for _ in paths]
    blank = {"n": 0, "first": NO_ID, "kids": 0, "leaves": 0, "saved": 0}

    # Where the run of rows of one length ends that a row is in.
    turns = np.append(np.flatnonzero(lengths[1:] != lengths[:-1]) + 1, len(order))
    run_end = turns[np.searchsorted(turns, np.arange(len(order)), side="right")]

    for depth, level in enumerate(found):
        # Members that end at a node are its first rows; the next row is longer or another node's.
        stop = np.minimum(run_end[level.start], np.append(level.start[1:], len(order)))
        stop = np.where(lengths[level.start] == depth, stop, level.start)
        ends = list(zip(level.start.tolist(), stop.tolist(), strict=True))

        whole = ~level.open
        if whole.any():
            kept = [ends[k] for k in np.flatnonzero(whole)]
            digests = [hashlib.sha256(_listed(conv[a:b]).encode()).hexdigest() if b > a else NOTHING for a, b in kept]
            # A parent that is open is found by its path, by all others' whole sums.
            outer = None
            if depth:
                above = found[depth - 1]
                of = level.parent[whole]
                sides = np.where(above.start[of] == 0, 0, 1)
                outer = [keys[s][depth - 1] if o else None for s, o in zip(sides.tolist(), above.open[of].tolist(), strict=True)]
            yield _node_batch(shard, order, found, depth, whole, ends_sha256=digests, key=outer)

        for k in np.flatnonzero(level.open):
            side = 0 if level.start[k] == 0 else 1
            for name, value in zip(SUMS, (level.n, level.first, level.kids, level.leaves, level.saved), strict=True):
                edges[side][name].append(int(value[k]))
            a, b = ends[k]
            for at in range(a, b, IDS_PER_ROW):
                own = conv[at : min(b, at + IDS_PER_ROW)]
                if text := _listed(own):
                    yield _batch("ends", 1, key=[keys[side][depth]], conv_id=_ids(own[own != NO_ID][:1]), convs=[text])

    for side, (row, sums) in enumerate(zip((order[0], order[-1]), edges, strict=True)):
        # Of the last path, nodes that are the first path's too are counted there.
        shared = len(paths[side]) + 1 - len(sums["n"])
        a, b = shard.starts[row], shard.starts[row + 1]
        yield _batch(
            "edge", 1, ids=[[p.tobytes() for p in paths[side]]], chars=[shard.chars[a:b].tolist()],
            **{c: [[blank[c]] * shared + sums[c]] for c in SUMS},
        )


def edge_nodes(shard: Shard) -> Iterator[pa.RecordBatch]:
    """The nodes of all edge paths, from their sums."""
    order = sorted_rows(shard)
    found = levels(shard, order, edges_open=False)
    keys = {int(r): path_keys(shard.raw[shard.starts[r] : shard.starts[r + 1]]) for r in order}
    for depth, level in enumerate(found):
        own = [keys[int(r)][depth] for r in order[level.start]]
        yield _node_batch(shard, order, found, depth, np.ones(len(level.start), dtype=bool), key=own)


def _mapped(rows: DataFrame, make) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            yield from make(_shard_of(pa.Table.from_batches(held)))
        release_memory()

    return rows.mapInArrow(work, FOUND)


def _digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of lists in pieces. A list is hashed as it streams by in order, so however
    long it is, one piece at a time is held."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])], ["key", "ends_sha256"])

        for batch in batches:
            for own, text in zip(batch.column(0), batch.column(1), strict=True):
                own = own.as_py()
                if own == key:
                    digest.update(b",")
                else:
                    if digest is not None:
                        yield done()
                    key, digest = own, hashlib.sha256()
                digest.update(text.as_py().encode())
        if digest is not None:
            yield done()

    rows = ends.select("key", "conv_id", "convs").repartition("key").sortWithinPartitions("key", "conv_id")
    return rows.select("key", "convs").mapInArrow(work, "key binary, ends_sha256 string")


def prefix_trie(paths: DataFrame) -> DataFrame:
    """The nodes of the trie of ``paths`` (conv_id, ids, chars), the textless root included.

    conv_id: a node's smallest member; depth; parent_conv_id: that of its parent (root: null);
    n_convs: conversations that start with the node's turns; n_children; n_leaves: childless nodes
    in its subtree, itself included; saved_tokens: summed over its subtree, each node's
    (n_convs - 1) times the ``chars`` of its last turn; ends_sha256: SHA-256 of the ascending,
    comma-joined ids of the conversations that end there; turn_id: the id of its last turn.

    A conversation without an id is a member, but not the smallest where there is another, nor
    listed among those that end. Without conversations there is no root: no rows.

    Paths are dealt by range, equal ones by id, so a hot path or first turn is shared out. What
    meets in one task are two paths of each shard, and, row by row, the ids that end at a node of these.
    """
    dealt = paths.select("conv_id", "ids", "chars").repartitionByRange("ids", "conv_id")
    found = written(_mapped(dealt, shard_nodes), "shards", partition_by="kind")
    edges = found.where("kind = 'edge'").select("ids", "chars", *SUMS).repartition(1)
    joined = _mapped(edges, edge_nodes).select("key", *[f.split()[0] for f in NODE.split(", ")])
    digests = _digests(found.where("kind = 'ends'"))
    joined = written(joined.drop("ends_sha256").join(digests, "key", "left"), "edges")

    names = [f.split()[0] for f in NODE.split(", ")]
    whole = found.where("kind = 'node'").select(*names, "key")
    parents = joined.select(F.col("key").alias("of"), F.col("conv_id").alias("outer"))
    outer = whole.where("key IS NOT NULL").join(parents, F.col("key") == F.col("of"))
    outer = outer.withColumn("parent_conv_id", F.col("outer"))
    edge = joined.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))
    return whole.where("key IS NULL").select(*names).union(outer.select(*names)).union(edge.select(*names))
