"""SimHash near-dedup with bit-sliced comparison.

1. Each text gets a fingerprint of ``bits`` bits: those set in over half of its shingles' hashes. The first 64
   hash bits are XXH64; longer fingerprints mix further ones from it.
2. Equal fingerprints become one. The others are put into buckets by some of their bits, and only buckets are
   compared. The buckets are exact: two fingerprints that differ in at most ``radius`` bits agree in two of
   ``radius + 2`` blocks of bits, so there is one bucket per pair of blocks and no link is missed. A bucket beyond
   ``TILE`` fingerprints is dealt out as pairs of tiles, each a task's work; its comparisons, not its links, grow with
   the square of its number of distinct fingerprints.
3. Within a bucket, the fingerprints are stored as bit planes, 64 fingerprints to a word. One fingerprint is
   compared with 64 at a time: plane by plane, the differing bits are added into carry-save counters, and a
   block whose 64 distances have all passed the radius is abandoned. A bucket yields a star for each cluster
   found, never all pairs.
4. The links form a graph of distinct fingerprints. Large-star and small-star rounds, each stored in the shared
   folder, contract it until every fingerprint points to the smallest one of its component.

``keep_one_per_group`` keeps one document of each such component.

Defined results: null and empty texts and texts without words have fingerprint zero; fewer words than a shingle
make one shingle; a null id can be linked but is never a component's id unless all its ids are null.
Very long texts are hashed in blocks of shingles; repeated rows share a fingerprint; further columns are not read, and
``keep_one_per_group`` hands them on whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweir.session import broadcast_if_small, materialize

SHINGLE_WORDS = 3
RADIUS = 3
BITS = 64
SEED = 42
TILE = 4096

_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
_CHUNK = 1 << 16


def _mixed(hashes: np.ndarray, bits: int) -> np.ndarray:
    """``bits`` hash bits per row: the hash itself, then further words mixed from it."""
    words = [hashes]
    for k in range(1, bits // 64):
        x = hashes + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        words.append(x ^ (x >> np.uint64(31)))
    return np.stack(words, axis=1)


def _unpacked(words: np.ndarray) -> np.ndarray:
    """One column per bit, from rows of 64-bit words; the lowest bit of the first word comes first."""
    return np.unpackbits(words.astype("<u8").view(np.uint8).reshape(len(words), -1), axis=1, bitorder="little")


def _shingle_hashes(text: bytes, words: int, block: int) -> tuple[int, Iterator[np.ndarray]]:
    """How many shingles a UTF-8 text has, repeated ones too, and their hashes in arrays of at most ``block``."""
    tokens = text.lower().split()  # on bytes: A-Z and the six ASCII white space characters only
    if not tokens:
        return 0, iter(())
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(tokens) - words + 1)
    starts, ends = starts[:n].tolist(), ends[min(words, len(tokens)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return n, (
        np.array([digest(joined[a:b], SEED) for a, b in zip(starts[k : k + block], ends[k : k + block])], dtype=np.uint64)
        for k in range(0, n, block)
    )


def fingerprint(text: bytes, words: int = SHINGLE_WORDS, bits: int = BITS) -> bytes:
    """The SimHash of a UTF-8 text, 64-bit words with the highest byte first.

    Bits are counted per block of shingles, so that long texts need no large array.
    """
    n, blocks = _shingle_hashes(text, words, _CHUNK * 64 // bits)
    if not n:
        return bytes(bits // 8)
    counts = np.zeros(bits, dtype=np.int64)
    for hashes in blocks:
        counts += _unpacked(_mixed(hashes, bits)).sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > n, bitorder="little").view("<u8").astype(">u8").tobytes()


def with_fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, bits: int = BITS) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``fp`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array([fingerprint(t.as_py() or b"", words, bits) for t in batch.column(2)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), prints], ["doc_id", "text_hash", "fp"])

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.encode("text", "UTF-8")
    ).mapInArrow(run, "doc_id long, text_hash long, fp binary")


def bit_tables(radius: int, bits: int) -> list[list[int]]:
    """The bits by which fingerprints are put into buckets, one list per table; no link within ``radius`` is missed."""
    if radius + 2 > bits:
        raise ValueError("the radius leaves no blocks of bits to agree in")
    blocks = [range(round(i * bits / (radius + 2)), round((i + 1) * bits / (radius + 2))) for i in range(radius + 2)]
    return [[*x, *y] for x, y in combinations(blocks, 2)]


def _words(column: pa.Array, bits: int) -> np.ndarray:
    """Rows of 64-bit words from a column of fingerprints."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=">u8").astype(np.uint64).reshape(-1, bits // 64)


def _printed(words: np.ndarray) -> pa.Array:
    raw, size = words.astype(">u8").tobytes(), words.shape[1] * 8
    return pa.array([raw[i : i + size] for i in range(0, len(raw), size)], pa.binary())


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """Plane ``j`` holds bit ``j`` of all fingerprints (rows of words), 64 fingerprints to a word."""
    padded = np.zeros((-(-len(prints) // 64) * 64, prints.shape[1]), dtype=np.uint64)
    padded[: len(prints)] = prints
    return np.packbits(np.ascontiguousarray(_unpacked(padded).T), axis=1, bitorder="little").view("<u8")


def _close_lanes(planes, prints, words, queries, closed, radius):
    """Which of 64 stored fingerprints (``words`` of the planes) lie within ``radius`` of the rows ``queries``.

    ``closed`` marks lanes that do not count. Counters start so that they overflow at ``radius + 1``, and
    rows whose lanes have all overflowed are dropped after every eight planes.
    """
    width = radius.bit_length()
    start = (1 << width) - (radius + 1)
    rows = np.arange(len(words))
    over = closed.copy()
    counters = [np.full(len(words), _FULL if start >> k & 1 else 0, dtype=np.uint64) for k in range(width)]
    for first in range(0, len(planes), 8):
        own = prints[queries, first // 64] >> np.uint64(first % 64)
        for j in range(8):
            carry = planes[first + j][words] ^ (np.uint64(0) - (own >> np.uint64(j) & np.uint64(1)))
            for counter in counters:
                carried = counter & carry
                counter ^= carry
                carry = carried
            over |= carry
        open_ = over != _FULL
        if not open_.all():
            rows, words, queries, over = rows[open_], words[open_], queries[open_], over[open_]
            counters = [c[open_] for c in counters]
        if not len(rows):
            break
    return rows, ~over


def _merged(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``labels`` after linking ``a`` to ``b``: every row carries the smallest row of its cluster."""
    while True:
        low = np.minimum(labels[a], labels[b])
        before = labels.copy()
        for side in (a, b):
            np.minimum.at(labels, before[side], low)
        labels = labels[labels]
        if np.array_equal(labels[a], labels[b]) and np.array_equal(labels, labels[labels]):
            return labels


def cluster_buckets(buckets: np.ndarray, prints: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For rows sorted by bucket, the first row of each row's cluster within its bucket."""
    n = len(prints)
    starts = np.flatnonzero(np.concatenate(([True], buckets[1:] != buckets[:-1])))
    ends = np.repeat(np.concatenate((starts[1:], [n])), np.diff(np.concatenate((starts, [n]))))
    planes = bit_planes(prints)
    labels = np.arange(n)
    for low in range(0, n, 1 << 14):
        rows = np.arange(low, min(n, low + (1 << 14)))
        rows = rows[ends[rows] > rows + 1]
        words = (rows + 1) // 64
        while len(rows):
            # lanes up to the row itself and from the bucket's end on are closed
            first = np.clip(rows + 1 - words * 64, 0, 63).astype(np.uint64)
            last = np.clip(ends[rows] - words * 64, 1, 64).astype(np.uint64)
            opened = (_FULL << first) & (_FULL >> (np.uint64(64) - last))
            hit, lanes = _close_lanes(planes, prints, words, rows, ~opened, radius)
            if len(hit):
                at, lane = np.nonzero(np.unpackbits(lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
                labels = _merged(labels, rows[hit][at], words[hit][at] * 64 + lane)
            words = words + 1
            more = words * 64 < ends[rows]
            rows, words = rows[more], words[more]
    return labels


def _links(batches: Iterator[pa.RecordBatch], radius: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Stars of close fingerprints, from rows ``(table, key, low, high, fp)`` that arrive sorted by bucket."""

    def linked(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        changed = np.any(keys[1:] != keys[:-1], axis=1)
        buckets = np.concatenate(([0], np.cumsum(changed)))
        several = np.bincount(buckets)[buckets] > 1
        buckets, prints = buckets[several], prints[several]
        labels = cluster_buckets(buckets, prints, radius) if len(prints) else np.arange(0)
        away = labels != np.arange(len(labels))
        return pa.RecordBatch.from_arrays([_printed(prints[away]), _printed(prints[labels[away]])], ["u", "v"])

    keys, prints = np.zeros((0, 4), dtype=np.int64), np.zeros((0, bits // 64), dtype=np.uint64)
    for batch in batches:
        keys = np.concatenate((keys, np.stack([np.asarray(c, dtype=np.int64) for c in batch.columns[:4]], axis=1)))
        prints = np.concatenate((prints, _words(batch.column(4), bits)))
        if len(keys) < _CHUNK:
            continue
        inside = np.any(keys != keys[-1], axis=1)
        ready = int(inside.nonzero()[0][-1]) + 1 if inside.any() else 0
        if ready:
            yield linked(keys[:ready], prints[:ready])
            keys, prints = keys[ready:], prints[ready:]
    if len(keys):
        yield linked(keys, prints)


def close_pairs(prints: DataFrame, radius: int = RADIUS, bits: int = BITS, tile: int = TILE) -> DataFrame:
    """Links ``u``, ``v`` that connect the distinct fingerprints ``fp`` within ``radius``, as stars; ``prints`` should be stored."""
    tables = bit_tables(radius, bits)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                part = batch.column(0).slice(low, 4096)
                unpacked = _unpacked(_words(part, bits)).astype(np.int64)
                for table, picked in enumerate(tables):
                    key = unpacked[:, picked] @ (np.int64(1) << np.arange(len(picked), dtype=np.int64))
                    at = pa.array(np.full(len(part), table))
                    yield pa.RecordBatch.from_arrays([at, pa.array(key), part], ["table", "key", "fp"])

    placed = prints.select("fp").mapInArrow(keyed, "table long, key long, fp binary")
    large = materialize(
        placed.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > tile), "large-buckets"
    )
    sized = placed.join(broadcast_if_small(large), ["table", "key"], "left")
    tiles = sized.withColumn("tiles", F.coalesce(F.ceil(F.col("n") / tile), F.lit(1)))
    own = tiles.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("tiles")))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    rows = dealt.select(
        "table", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp"
    )
    keys = ["table", "key", "low", "high"]
    return (
        rows.repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(lambda batches: _links(batches, radius, bits), "u binary, v binary")
        .distinct()
    )


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round over ``edges`` (u > v): neighbours move to the smallest neighbour.

    Large: of every node, the larger neighbours. Small: of every node, its smaller neighbours and itself.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        moved = both.join(least, "u").filter("v > u").selectExpr("v as u", "m as v")
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least, "u").filter("v <> m").selectExpr("v as u", "m as v").unionByName(
            least.selectExpr("u", "m as v")
        )
    return moved.filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``u`` and the smallest ``root`` of its component, for every node of ``links`` that is not a root itself."""

    def state(df: DataFrame) -> tuple:
        row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(row)

    edges = materialize(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "links"
    )
    before = state(edges)
    while True:
        edges = materialize(_star(_star(edges, large=True), large=False), "stars")
        after = state(edges)
        if after == before:
            return edges.withColumnRenamed("v", "root")
        before = after


def near_duplicate_groups(
    docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS, bits: int = BITS, tile: int = TILE
) -> DataFrame:
    """One row per document: ``doc_id``, ``text_hash``, ``fp``, ``root`` (the group's smallest fingerprint) and ``component_id``."""
    stored = materialize(with_fingerprints(docs, words, bits), "fingerprints")
    prints = materialize(
        stored.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "prints"
    )
    roots = components(close_pairs(prints.select("fp"), radius, bits, tile))
    members = roots.select(F.col("u").alias("fp"), "root").unionByName(
        roots.select(F.col("root").alias("fp"), "root").distinct()
    )
    shared = prints.join(members, "fp", "left").filter("n > 1 OR root IS NOT NULL")
    shared = shared.select("fp", F.coalesce("root", "fp").alias("root"), "first")
    least = shared.groupBy("root").agg(F.min("first").alias("component_id"))
    groups = materialize(shared.select("fp", "root").join(least, "root"), "groups")
    joined = stored.join(groups, "fp", "left")
    return joined.select(
        "doc_id",
        "text_hash",
        "fp",
        F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def simhash_components(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``."""
    groups = near_duplicate_groups(docs)
    return groups.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def keep_one_per_group(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id (nulls last), then text hash; repeated rows once.

    Groups are those of ``near_duplicate_groups`` at its own shingle length and radius, as in ``simhash_components``.
    """
    groups = near_duplicate_groups(docs.select("doc_id", "text"), tile=tile)
    rank = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("text_hash").alias("c"))
    keepers = groups.groupBy("root").agg(F.min(rank).alias("_k")).select(F.col("_k.b").alias("_b"), F.col("_k.c").alias("_c"))
    packed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"),
        F.col("doc_id").cast("long").alias("_id"),
        F.xxhash64("text").alias("_hash"),
    )
    kept = packed.join(keepers, F.col("_id").eqNullSafe(F.col("_b")) & (F.col("_hash") == F.col("_c")), "left_semi")
    return kept.dropDuplicates(["_id", "_hash"]).select("_row.*")
