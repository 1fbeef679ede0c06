"""Conversation prefix trie: padded turn-id matrices, sorted and cut into nodes by NumPy, in range shards that recombine.

1. Turns. A turn is a 128-bit hash of its role and text and its number of code points. A conversation's turns are numbered
   over the sorted table, by ranges, so that one conversation may hold any share of all turns. A turn's hash is
   mixed with its place, so the xor of a conversation's first ``d`` turns is the key of its node at depth ``d``.
2. Segments. A conversation is cut into segments of ``WIDTH`` turns. A segment carries the key of the node above it, a
   running xor over the earlier segments. So a matrix is never wider than ``WIDTH``, however long conversations are.
3. Shards. Segments are sorted by depth, key and turns over the whole table, and cut into shards of at most
   ``SHARD_ROWS`` rows. In a shard, turn ids form a padded matrix. ``lexsort`` orders its rows, a mask marks the columns that
   differ from the row before, and OR-accumulated along the rows it marks every node's start at every depth.
   ``reduceat`` between the starts aggregates the nodes of a depth.
4. Boundaries. A node is open if it holds a row at an edge of its shard, or joins two segments (the root, too); all others are
   whole within their shard. The first pass sends up the parts of open nodes and they are added up by key. The second
   pass gets back what its shard's open nodes turned out to be, and its parts of them are added up at the end.
5. Sums over subtrees. A node's own value is held by one of its rows. What lies in deeper segments is added up per
   conversation from the last segment to the first, and reaches the nodes above through their rows.

Digests of the conversations that end in a node need them in ascending order. They are joined within shards; the pieces of an
open node pass one task in order, as a digest must, but as long pieces and never held together.

Defined results: turns are ordered by turn (null first), then by hash, and repeated rows are turns of their own; null role
or text is empty; rows with a null conversation id belong to no conversation; conversations without turns are
members of the root; texts of any length are hashed in full and do not move; further columns are ignored; an empty
table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweir.llm.scans import ordered, running
from tallyweir.session import broadcast_if_small, materialize

WIDTH = 32
SHARD_ROWS = 4096
FAMILY = 100
MOST_SHARED = 6
PIECE_IDS = 256

_NODE = ["depth", "hi", "lo"]
_PART = "shard long, conv_id long, seg long, depth long, hi long, lo long, p_hi long, p_lo long, n long, conv long, goes_on boolean, chars long, leaves long, saved long"
_OUT = (
    "kind int, depth long, hi long, lo long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string, first long, ids string"
)
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def hashed_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, the turn's hash ``hi``, ``lo`` and its ``chars``; the texts stay where they are."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("hi"),
        F.xxhash64(F.lit(1), text, role).alias("lo"),
        F.char_length(text).cast("long").alias("chars"),
    )


def _no_turns(*fields: str) -> Column:
    return F.slice(F.array(F.struct(*(F.lit(0).cast("long").alias(c) for c in fields))), F.lit(1), F.lit(0))


def rebuilt_turns(turns: DataFrame, family: int = FAMILY, most: int = MOST_SHARED) -> tuple[DataFrame, DataFrame]:
    """Conversations that share heads: their turns (``conv_id``, ``pos``, ``hi``, ``lo``, ``chars``) and ``length`` by ``conv_id``.

    The first ``crc32(id) % most`` turns of each are those of its family's first one, ``id - id % family``.
    """
    turns = ordered(turns, [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("hi"), F.col("lo")], "turns")
    ranges = turns.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    ranges = materialize(running(ranges, ["conv_id"], "part", {"n": "sum"}), "ranges")
    place = F.col("n_before") + F.col("row") - F.col("first")
    placed = turns.join(broadcast_if_small(ranges), ["conv_id", "part"]).withColumn("place", place)

    lengths = ranges.groupBy("conv_id").agg(F.sum("n").alias("own"))
    heads = materialize(
        placed.filter((F.col("conv_id") % family == 0) & (F.col("place") < most - 1))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "hi", "lo", "chars"))).alias("head")),
        "heads",
    )
    shared = (F.crc32(F.col("conv_id").cast("string")) % most).alias("shared")
    known = lengths.select("conv_id", "own", shared, (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    known = known.join(broadcast_if_small(heads), "base", "left")
    head = F.slice("head", F.lit(1), F.col("shared").cast("int"))
    known = known.withColumn("head", F.coalesce(head, _no_turns("place", "hi", "lo", "chars")))
    known = known.withColumn("length", F.size("head") + F.greatest(F.col("own") - F.col("shared"), F.lit(0)))
    known = materialize(known.select("conv_id", "shared", "head", F.col("length").cast("long").alias("length")), "rebuilt")

    taken = known.select("conv_id", F.explode("head").alias("h")).select(
        "conv_id", F.col("h.place").alias("pos"), *(F.col(f"h.{c}").alias(c) for c in ("hi", "lo", "chars"))
    )
    shifts = known.select("conv_id", "shared", (F.size("head") - F.col("shared")).alias("shift"))
    by_range = materialize(ranges.select("conv_id", "part", "first", "n_before").join(shifts, "conv_id"), "shifts")
    own = turns.join(broadcast_if_small(by_range), ["conv_id", "part"]).withColumn("place", place).filter("place >= shared")
    own = own.select("conv_id", (F.col("place") + F.col("shift")).alias("pos"), "hi", "lo", "chars")
    return taken.unionByName(own), known.select("conv_id", "length")


def segments(turns: DataFrame, lengths: DataFrame, width: int = WIDTH) -> DataFrame:
    """Stored segments: ``conv_id``, ``seg``, ``k_hi`` and ``k_lo`` of the node above, ``turns``, and whether more follow."""
    mixed = turns.select(
        "conv_id",
        F.expr(f"pos div {width}").alias("seg"),
        F.struct("pos", F.xxhash64("pos", "hi", "lo").alias("hi"), F.xxhash64("lo", "hi", "pos").alias("lo"), "chars").alias("t"),
    )
    cut = mixed.groupBy("conv_id", "seg").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    plain = F.transform("turns", lambda t: F.struct(t["hi"].alias("hi"), t["lo"].alias("lo"), t["chars"].alias("chars")))
    folded = [F.expr(f"aggregate(turns, 0L, (x, t) -> x ^ t.{c})").alias(f"x_{c}") for c in ("hi", "lo")]
    cut = materialize(cut.select("conv_id", "seg", plain.alias("turns"), *folded), "cut")

    last = F.expr(f"greatest(length - 1, 0) div {width}")
    nothing = _no_turns("hi", "lo", "chars")
    turnless = lengths.filter("length = 0").select("conv_id", F.lit(0).cast("long").alias("seg"), nothing.alias("turns"))
    long_ones = broadcast_if_small(materialize(lengths.filter(F.col("length") > width).select("conv_id", last.alias("last")), "long"))
    zero = F.lit(0).cast("long")
    several = cut.join(long_ones, "conv_id")
    several = running(several, ["conv_id"], "seg", {"x_hi": "bit_xor", "x_lo": "bit_xor"}).select(
        "conv_id", "seg", "turns", F.col("x_hi_before").alias("k_hi"), F.col("x_lo_before").alias("k_lo"), (F.col("seg") < F.col("last")).alias("more")
    )
    single = cut.join(long_ones, "conv_id", "left_anti").select("conv_id", "seg", "turns").unionByName(turnless)
    single = single.select("conv_id", "seg", "turns", zero.alias("k_hi"), zero.alias("k_lo"), F.lit(False).alias("more"))
    return single.unionByName(several)


def sharded(pieces: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``pieces`` in order over the whole table, stored with ``shard`` and ``edge``: the first and last row of each shard."""
    order = ["seg", "k_hi", "k_lo", "turns", "conv_id"]
    partitions = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = pieces.select(*order, "more").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 40
        for batch in batches:
            for low in range(0, batch.num_rows, shard_rows):
                part = batch.slice(low, shard_rows)
                edge = np.zeros(part.num_rows, dtype=bool)
                edge[[0, -1]] = True
                columns = [*part.columns, pa.array(np.full(part.num_rows, shard)), pa.array(edge)]
                yield pa.RecordBatch.from_arrays(columns, [*order, "more", "shard", "edge"])
                shard += 1

    placed = pieces.select(*order, "more").repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    return materialize(placed.mapInArrow(run, schema.add("shard", "long").add("edge", "boolean")), "shards")


class Level(NamedTuple):
    """The nodes of one depth in a shard: their rows, where each node starts among those, and what is known of each."""

    rows: np.ndarray  # the shard's rows that reach this depth
    starts: np.ndarray  # the nodes' first rows, as places in ``rows``
    parent: np.ndarray  # the node above, as a place in the level above
    is_open: np.ndarray
    hi: np.ndarray
    lo: np.ndarray

    @property
    def first(self) -> np.ndarray:
        return self.rows[self.starts]


def _long(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(np.int64, copy=False)


class Shard:
    """One shard's rows, sorted, and its nodes by depth below the segments' start."""

    def __init__(self, table: pa.Table):
        turns = table.column("turns").combine_chunks()
        sizes = np.diff(np.asarray(turns.offsets)).astype(np.int64)
        items, width = turns.flatten(), int(sizes.max(initial=0))
        filled = np.arange(width) < sizes[:, None]
        hi, lo, chars = (np.zeros((len(sizes), width), dtype=np.int64) for _ in range(3))
        for matrix, name in ((hi, "hi"), (lo, "lo"), (chars, "chars")):
            matrix[filled] = np.asarray(items.field(name))
        conv, seg, k_hi, k_lo = (_long(table.column(c)) for c in ("conv_id", "seg", "k_hi", "k_lo"))
        keys = [conv]
        for j in reversed(range(width)):
            keys += [lo[:, j], hi[:, j], filled[:, j]]
        order = np.lexsort([*keys, k_lo, k_hi, seg])
        self.conv, self.seg, self.sizes = conv[order], seg[order], sizes[order]
        self.more = table.column("more").to_numpy()[order]
        self.edge = table.column("edge").to_numpy()[order]
        self.chars, self.width = chars[order], width
        hi, lo, filled, k_hi, k_lo = hi[order], lo[order], filled[order], k_hi[order], k_lo[order]

        # a change in the segment's key or in any column up to this one starts a node here
        changed = np.ones((len(order), width + 1), dtype=bool)
        changed[1:, 0] = (self.seg[1:] != self.seg[:-1]) | (k_hi[1:] != k_hi[:-1]) | (k_lo[1:] != k_lo[:-1])
        changed[1:, 1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1]) | (filled[1:] != filled[:-1])
        np.logical_or.accumulate(changed, axis=1, out=changed)
        node_hi = np.bitwise_xor.accumulate(np.column_stack([k_hi, hi]), axis=1)
        node_lo = np.bitwise_xor.accumulate(np.column_stack([k_lo, lo]), axis=1)

        self.levels: list[Level] = []
        for j in range(width + 1):
            rows = np.flatnonzero(self.sizes >= j)
            starts = np.flatnonzero(changed[rows, j])
            if not len(starts):
                break
            first = rows[starts]
            is_open = np.logical_or.reduceat(self.edge[rows], starts) | np.logical_or.reduceat(self.goes_deeper(rows, j), starts)
            if j == 0:
                parent, is_open[:] = np.zeros(len(starts), dtype=np.int64), True
            else:
                parent = np.searchsorted(self.levels[-1].first, first, side="right") - 1
            self.levels.append(Level(rows, starts, parent, is_open, node_hi[first, j], node_lo[first, j]))

    def goes_deeper(self, rows: np.ndarray, j: int) -> np.ndarray:
        """Which rows go on in a further segment after depth ``j``."""
        return self.more[rows] & (self.sizes[rows] == j)

    def node_values(self, j: int) -> tuple[np.ndarray, ...]:
        """Members, smallest member, whether any goes on, and the last text's length, of the nodes at ``j``."""
        level = self.levels[j]
        rows, starts = level.rows, level.starts
        n = np.add.reduceat(np.ones(len(rows), dtype=np.int64), starts)
        conv = np.minimum.reduceat(self.conv[rows], starts)
        goes_on = np.logical_or.reduceat((self.sizes[rows] > j) | self.more[rows], starts)
        chars = self.chars[level.first, j - 1] if j else np.zeros(len(starts), dtype=np.int64)
        return n, conv, goes_on, chars


def _table(schema: list[str], parts: list[dict]) -> pa.Table:
    """One table from columns per level; what a level lacks is null."""
    kinds = {"goes_on": pa.bool_(), "kind": pa.int32(), "ends_sha256": pa.string(), "ids": pa.string()}
    made = []
    for part in parts:
        size = next(len(v) for v in part.values() if v is not None)
        made.append(
            pa.table({
                c: pa.array(part[c], kinds.get(c, pa.int64())) if part.get(c) is not None else pa.nulls(size, kinds.get(c, pa.int64()))
                for c in schema
            })
        )
    return pa.concat_tables(made) if made else pa.table({c: pa.array([], kinds.get(c, pa.int64())) for c in schema})


_PART_NAMES = [c.split()[0] for c in _PART.split(", ")]
_OUT_NAMES = [c.split()[0] for c in _OUT.split(", ")]


def open_parts(table: pa.Table, width: int) -> pa.Table:
    """First pass: parts of the open nodes, and for deeper segments the values of all others, added up per segment key."""
    shard, number = Shard(table), table.column("shard")[0].as_py()
    parts = []
    leaves = np.zeros(len(shard.conv), dtype=np.int64)
    saved = np.zeros(len(shard.conv), dtype=np.int64)
    for j, level in enumerate(shard.levels):
        n, conv, goes_on, chars = shard.node_values(j)
        closed = ~level.is_open
        leaves[level.first] += closed & ~goes_on
        saved[level.first] += np.where(closed, (n - 1) * chars, 0)
        at, size = level.is_open, int(level.is_open.sum())
        first, seg = level.first[at], shard.seg[level.first[at]]
        inner = seg > 0 if j == 0 else np.zeros(size, dtype=bool)  # the node's members are counted a segment above
        above = shard.levels[j - 1] if j else level
        parent = level.parent[at]
        parts.append({
            "shard": np.full(size, number), "conv_id": shard.conv[first], "seg": seg, "depth": seg * width + j,
            "hi": level.hi[at], "lo": level.lo[at],
            "p_hi": above.hi[parent] if j else None, "p_lo": above.lo[parent] if j else None,
            "n": np.where(inner, 0, n[at]), "conv": [None if i else c for i, c in zip(inner.tolist(), conv[at].tolist())],
            "goes_on": goes_on[at] | inner, "chars": np.where(inner, 0, chars[at]),
        })
    top = shard.levels[0]
    sums = [np.add.reduceat(v, top.first) for v in (leaves, saved)]
    deep = shard.seg[top.first] > 0
    if deep.any():
        parts.append({
            "conv_id": shard.conv[top.first][deep], "seg": shard.seg[top.first][deep], "leaves": sums[0][deep], "saved": sums[1][deep],
        })
    return _table(_PART_NAMES, parts)


def _digest(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()


def all_nodes(table: pa.Table, known: pa.Table, width: int) -> pa.Table:
    """Second pass: whole rows of closed nodes (kind 0), parts of open ones (1), and pieces of their ids (2).

    ``known`` tells of each open node its smallest member, and its own values if this shard holds them for all.
    """
    shard = Shard(table)
    below = table.select(["conv_id", "seg", "leaves", "saved"])
    place = {k: i for i, k in enumerate(zip(below.column("conv_id").to_pylist(), below.column("seg").to_pylist()))}
    order = np.array([place[k] for k in zip(shard.conv.tolist(), shard.seg.tolist())], dtype=np.int64)
    leaves, saved = (_long(below.column(c))[order].copy() for c in ("leaves", "saved"))
    columns = ("seg", *_NODE, "conv", "leaf", "value")
    told = {tuple(row[:4]): row[4:] for row in zip(*(known.column(c).to_pylist() for c in columns))}
    convs, values = [], []
    for j, level in enumerate(shard.levels):
        n, conv, goes_on, chars = shard.node_values(j)
        leaf, value = (~goes_on).astype(np.int64), (n - 1) * chars
        for i in np.flatnonzero(level.is_open).tolist():
            seg = int(shard.seg[level.first[i]])
            conv[i], leaf[i], value[i] = told[seg, seg * width + j, int(level.hi[i]), int(level.lo[i])]
        convs.append(conv)
        values.append((n, leaf, value))

    parts = []
    child = np.zeros(len(shard.conv), dtype=np.int64)
    closed_child = np.zeros(len(shard.conv), dtype=np.int64)
    for j in reversed(range(len(shard.levels))):
        level, (n, leaf, value) = shard.levels[j], values[j]
        rows, starts, first = level.rows, level.starts, level.first
        leaves[first] += leaf
        saved[first] += value
        whole = ~level.is_open
        children = np.where(whole, np.add.reduceat(child[rows], starts), np.add.reduceat(closed_child[rows], starts))
        # what lies below a segment's top has reached its node through the rows of the segment above
        own = (shard.seg[first] == 0) | (j > 0)
        made = {
            "depth": shard.seg[first] * width + j, "hi": level.hi, "lo": level.lo, "conv_id": convs[j],
            "parent_conv_id": convs[j - 1][level.parent] if j else None, "n_convs": n, "n_children": children,
            "n_leaves": np.add.reduceat(leaves[rows], starts) * own, "saved_tokens": np.add.reduceat(saved[rows], starts) * own,
        }
        ended = (shard.sizes[rows] == j) & ~shard.more[rows]
        node_of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(rows))))[ended]
        ids = shard.conv[rows[ended]]
        bounds = np.searchsorted(node_of, np.arange(len(starts) + 1))
        digests = [_digest(ids[a:b]) if b > a else _NO_ENDS for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        for kind, at in ((0, whole), (1, ~whole)):
            part = {c: v if v is None else v[at] for c, v in made.items()}
            part["kind"] = np.full(int(at.sum()), kind)
            if kind == 0:
                part["ends_sha256"] = [d for d, w in zip(digests, whole.tolist()) if w]
            parts.append(part)
        cut = [
            (i, ids[low : min(low + PIECE_IDS, bounds[i + 1])])
            for i in np.flatnonzero(level.is_open).tolist()
            for low in range(bounds[i], bounds[i + 1], PIECE_IDS)
        ]
        at = np.array([i for i, _ in cut], dtype=np.int64)
        parts.append({
            "kind": np.full(len(cut), 2), "depth": made["depth"][at], "hi": level.hi[at], "lo": level.lo[at],
            "first": [int(x[0]) for _, x in cut], "ids": [",".join(map(str, x.tolist())) for _, x in cut],
        })
        child[:] = closed_child[:] = 0
        child[first] = 1
        closed_child[first[whole]] = 1
    return _table(_OUT_NAMES, parts)


def _digests(pieces: DataFrame) -> DataFrame:
    """The digest of each node's ids, from pieces in ascending order; only one piece is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(node: tuple, digest) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in (*node, digest.hexdigest())], [*_NODE, "ends_sha256"])

        node = digest = None
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in range(3)), batch.column(4))
            for key, group in groupby(rows, key=lambda r: r[:3]):
                if key != node:
                    if digest:
                        yield made(node, digest)
                    node, digest = key, hashlib.sha256()
                    digest.update(next(group)[3].as_py().encode())
                for row in group:
                    digest.update(b"," + row[3].as_py().encode())
        if digest:
            yield made(node, digest)

    sorted_pieces = pieces.select(*_NODE, "first", "ids").repartition(*_NODE).sortWithinPartitions(*_NODE, "first")
    return sorted_pieces.mapInArrow(run, "depth long, hi long, lo long, ends_sha256 string")


def trie_nodes(turns: DataFrame, lengths: DataFrame, width: int = WIDTH, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The nodes of the trie of all conversations in ``lengths``, whose turns are ``turns`` (see ``rebuilt_turns``)."""
    shards = sharded(segments(turns, lengths, width), shard_rows)
    parts = materialize(shards.groupBy("shard").applyInArrow(lambda t: open_parts(t, width), _PART), "open-parts")

    found = parts.filter("shard IS NOT NULL")
    nodes = found.groupBy(*_NODE).agg(
        F.sum("n").alias("n"), F.min("conv").alias("conv"), F.bool_or("goes_on").alias("goes_on"),
        F.max("chars").alias("chars"), F.max("p_hi").alias("p_hi"), F.max("p_lo").alias("p_lo"),
    )
    leaf, value = (~F.col("goes_on")).cast("long"), (F.col("n") - 1) * F.col("chars")
    nodes = materialize(nodes.withColumn("leaf", leaf).withColumn("value", value), "open-nodes")

    # the part with the smallest member holds the node's own values for all
    held = found.join(broadcast_if_small(nodes.select(*_NODE, F.col("conv").alias("least"), "leaf", "value")), _NODE)
    held = materialize(held.withColumn("holds", F.coalesce(F.col("conv") == F.col("least"), F.lit(False))), "held")
    zero = F.lit(0).cast("long")
    known = held.select(
        "shard", "seg", *_NODE, F.col("least").alias("conv"),
        F.when(F.col("holds"), F.col("leaf")).otherwise(zero).alias("leaf"), F.when(F.col("holds"), F.col("value")).otherwise(zero).alias("value"),
    )

    deep = parts.filter("shard IS NULL").select("conv_id", "seg", "leaves", "saved").unionByName(
        held.filter("seg > 0 AND holds").select("conv_id", "seg", F.col("leaf").alias("leaves"), F.col("value").alias("saved"))
    )
    several = shards.filter("more OR seg > 0").select("conv_id", "seg", zero.alias("leaves"), zero.alias("saved"))
    deep = deep.unionByName(several).groupBy("conv_id", "seg").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    deep = materialize(running(deep, ["conv_id"], "seg", {"leaves": "sum", "saved": "sum"}), "deep")
    totals = deep.groupBy("conv_id").agg(F.sum("leaves").alias("all_leaves"), F.sum("saved").alias("all_saved"))
    below = deep.join(totals, "conv_id").select(
        "conv_id", "seg", (F.col("all_leaves") - F.col("leaves_before") - F.col("leaves")).alias("leaves"),
        (F.col("all_saved") - F.col("saved_before") - F.col("saved")).alias("saved"),
    )
    below = broadcast_if_small(materialize(below.filter("leaves <> 0 OR saved <> 0"), "below"))
    filled = shards.join(below, ["conv_id", "seg"], "left").fillna(0, ["leaves", "saved"])
    made = filled.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(lambda a, b: all_nodes(a, b, width), _OUT)
    made = materialize(made, "nodes")

    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    whole = made.filter("kind = 0").select(*columns)
    open_ = made.filter("kind = 1").groupBy(*_NODE).agg(
        F.max("parent_conv_id").alias("parent_conv_id"), F.sum("n_children").alias("closed_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
    )
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p_hi").alias("hi"), F.col("p_lo").alias("lo"))
    children = children.agg(F.count(F.lit(1)).alias("open_children"))
    digests = _digests(made.filter("kind = 2"))
    joined = nodes.select(*_NODE, F.col("conv").alias("conv_id"), F.col("n").alias("n_convs")).join(open_, _NODE)
    joined = joined.join(children, _NODE, "left").join(digests, _NODE, "left")
    joined = joined.withColumn("n_children", F.col("closed_children") + F.coalesce("open_children", zero))
    joined = joined.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_ENDS)))
    return whole.unionByName(joined.select(*columns))


def conversation_trie(conversations: DataFrame, width: int = WIDTH, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations."""
    return trie_nodes(*rebuilt_turns(hashed_turns(conversations)), width, shard_rows)


#: The same nodes by plain grouping of prefixes; the first part is CRC-32, bit by bit.
ORACLE_SQL = r"""
WITH ids AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
         list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))) AS codes
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (
  SELECT conv_id, base,
         xor(list_reduce(codes, lambda a, c: list_reduce(
           list_prepend(xor(a, c), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
           lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)), 4294967295::BIGINT) % 6 AS h
  FROM ids),
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos,
         struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) AS said FROM conversations),
rebuilt AS (
  SELECT c.conv_id, t.pos, t.said FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos < c.h
  UNION ALL SELECT c.conv_id, 100 + t.pos, t.said FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos >= c.h),
said AS (
  SELECT c.conv_id, coalesce(list(r.said ORDER BY r.pos) FILTER (r.said IS NOT NULL), []) AS said
  FROM convs c LEFT JOIN rebuilt r ON c.conv_id = r.conv_id GROUP BY c.conv_id),
members AS (
  SELECT conv_id, d, len(said) AS n, said[1:d] AS prefix
  FROM (SELECT conv_id, said, unnest(range(0, len(said) + 1)) AS d FROM said)),
placed AS (SELECT conv_id, d, n, prefix, min(conv_id) OVER (PARTITION BY d, prefix) AS node FROM members),
nodes AS (
  SELECT node, d, count(*) AS n_convs, NOT bool_or(n > d) AS leaf,
         (count(*) - 1) * coalesce(max(length(prefix[d].t)), 0) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
  FROM placed GROUP BY node, d),
above AS (SELECT u.*, p.node AS parent FROM nodes u LEFT JOIN placed p ON p.conv_id = u.node AND p.d = u.d - 1),
below AS (
  SELECT p.node, p.d, sum(CAST(leaf AS BIGINT)) AS n_leaves, sum(saved) AS saved_tokens
  FROM nodes u JOIN placed p ON p.conv_id = u.node AND p.d <= u.d GROUP BY p.node, p.d),
children AS (SELECT parent, d - 1 AS d, count(*) AS n_children FROM above GROUP BY ALL)
SELECT a.node AS conv_id, a.d AS depth, a.parent AS parent_conv_id, a.n_convs, CAST(coalesce(c.n_children, 0) AS BIGINT) AS n_children,
       CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, a.ends_sha256
FROM above a JOIN below b ON a.node = b.node AND a.d = b.d
LEFT JOIN children c ON c.parent = a.node AND c.d = a.d
"""
