"""Nearest neighbours by stored hash buckets: random hyperplanes, several probes per table, exact distances.

Every vector is put into one bucket of each of ``TABLES`` tables, by the sides of ``bits`` random planes through the mean on which
it lies. Buckets are published as a table, each row
with its vector, so what a probe finds needs no second look-up. A question probes its own bucket and those beyond the planes
it lies nearest to, the cheapest sets of planes first. Candidates are ranked by exact distance.

How many probes are needed is measured, not guessed: for ``SAMPLE_QUESTIONS`` held-out vectors and their exact neighbours, the
place of each neighbour's bucket in the question's order of probes is known without a search, so the least number of probes that
finds a ``TARGET`` share of them can be read off. Of a few numbers of planes, from about ``BUCKET_ROWS`` vectors a bucket
down, that with the least share of buckets to look into is taken. Both numbers are published with the index. The share of vectors that a search scores
depends on the data: little where neighbours lie much nearer than others, most of them in vectors without any structure.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweir.operators.lists import UNKNOWN
from tallyweir.operators.search import BLOCK_CELLS, flat_list, round_score, search_top_k
from tallyweir.operators.vector import vector_topk
from tallyweir.session import broadcast_if_small, materialize
from tallyweir.sources.sinks import publish_snapshot, read_snapshot

TABLES = 16
BUCKET_ROWS = 64
MAX_BITS = 24
ORDERED_BITS = 12  # planes whose sets are tried, the nearest ones: at most 2 ** 12 probes a table
FINER = (0, 2, 4)
MOST_PROBES = 64  # more are asked only where the coarsest buckets need them
SAMPLE_QUESTIONS = 100
TARGET = 0.95
SEED = 42
#: Up to so many questions travel to the buckets whole; more are laid out as a grid, see ``search_top_k``.
QUERY_LIMITS = (50_000, 128 * 1024 * 1024, 50_000)


def planes(dims: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((tables, bits, dims))


def sides(vectors: np.ndarray, mean: np.ndarray, normals: np.ndarray) -> np.ndarray:
    """The signed distance of every vector to every plane: vectors x tables x bits."""
    return np.einsum("nd,tbd->ntb", vectors - mean, normals)


def codes(away: np.ndarray) -> np.ndarray:
    return (away > 0) @ (np.int64(1) << np.arange(away.shape[-1], dtype=np.int64))


def probe_masks(away: np.ndarray, n: int | None = None) -> np.ndarray:
    """For one question and table, the bits to flip for each probe, the nearest buckets first."""
    nearest = np.argsort(np.abs(away), kind="stable")[:ORDERED_BITS]
    sets = np.arange(1 << len(nearest))
    member = sets[:, None] >> np.arange(len(nearest)) & 1
    cost = member @ (away[nearest] ** 2)
    masks = member @ (np.int64(1) << nearest.astype(np.int64))
    return masks[np.argsort(cost, kind="stable")][:n]


def _matrix(column) -> np.ndarray:
    items, lengths = flat_list(column)
    return items.to_numpy(zero_copy_only=False).astype(float).reshape(len(lengths), int(lengths[0]) if len(lengths) else 0)


@dataclass(frozen=True)
class HashedIndex:
    """The published tables under ``root``: ``buckets`` (tbl, code, keys, embedding) and ``figures``."""

    spark: SparkSession
    root: str
    keys: list[str]

    @cached_property
    def buckets(self) -> DataFrame:
        return read_snapshot(self.spark, f"{self.root}/buckets")

    @cached_property
    def figures(self):
        return read_snapshot(self.spark, f"{self.root}/figures").first()


def needed_probes(
    asked: np.ndarray, found: np.ndarray, mean: np.ndarray, normals: np.ndarray, target: float = TARGET
) -> int:
    """The least number of probes per table by which ``target`` of the pairs (rows of both) meet in some table."""
    of_question, of_neighbour = sides(asked, mean, normals), codes(sides(found, mean, normals))
    own = codes(of_question)
    most = 1 << min(ORDERED_BITS, normals.shape[1])
    place = np.full(len(asked), most, dtype=np.int64)
    for i in range(len(asked)):
        for t in range(normals.shape[0]):
            at = np.flatnonzero(probe_masks(of_question[i, t]) == (own[i, t] ^ of_neighbour[i, t]))
            if len(at):
                place[i] = min(place[i], at[0] + 1)
    return int(np.sort(place)[min(len(place) - 1, int(np.ceil(target * len(place))) - 1)]) if len(place) else 1


def layout(asked: np.ndarray, found: np.ndarray, mean: np.ndarray, n: int, tables: int, target: float) -> tuple[int, int]:
    """The number of planes, and of probes per table, that look into the least share of all buckets."""
    coarse = int(np.clip(round(np.log2(max(1, n / BUCKET_ROWS))), 1, MAX_BITS))
    tried = []
    for bits in sorted({min(MAX_BITS, coarse + finer) for finer in FINER}):
        probes = needed_probes(asked, found, mean, planes(len(mean), bits, tables), target)
        if bits == coarse or probes <= MOST_PROBES:
            tried.append((1 - (1 - probes / 2**bits) ** tables, bits, probes))
    return min(tried)[1:]


def publish_hashed(
    vectors: DataFrame, keys: list[str], root: str, k: int = 15, tables: int = TABLES, target: float = TARGET
) -> HashedIndex:
    """Index all ``vectors`` (keys, embedding) for searches of ``k``; rows without a vector take no part."""
    spark = vectors.sparkSession
    whole = vectors.select(*keys, F.col("embedding").cast("array<double>").alias("embedding")).filter("embedding IS NOT NULL")
    whole = materialize(whole, "vectors")
    n = whole.count()
    middle = whole.select(vector_to_array(Summarizer.mean(array_to_vector("embedding")))).first()[0] if n else []
    mean = np.array(middle, dtype=float)
    sample = whole.orderBy(F.xxhash64(F.lit(SEED), *keys)).limit(SAMPLE_QUESTIONS)
    sample = materialize(sample.select(F.xxhash64(*keys).alias("query_id"), "embedding"), "sample-questions")
    exact = vector_topk(whole, sample, keys, k).select("query_id", *keys)
    pairs = exact.join(sample.withColumnRenamed("embedding", "wanted"), "query_id").join(whole, keys).toArrow()
    bits, probes = layout(_matrix(pairs.column("wanted")), _matrix(pairs.column("embedding")), mean, n, tables, target) if n else (1, 1)
    normals = planes(len(mean), bits, tables)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            code = codes(sides(_matrix(batch.column("embedding")), mean, normals))
            for t in range(tables):
                head = [pa.array(np.full(len(code), t, dtype=np.int32)), pa.array(code[:, t])]
                yield pa.RecordBatch.from_arrays([*head, *batch.columns], ["tbl", "code", *keys, "embedding"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in whole.schema)
    rows = whole.mapInArrow(placed, f"tbl int, code long, {kinds}")
    sorted_rows = rows.repartition("tbl", F.pmod(F.xxhash64("code"), F.lit(16))).sortWithinPartitions("tbl", "code")
    publish_snapshot(sorted_rows, f"{root}/buckets", partition_by=["tbl"])

    figures = [(n, mean.tolist(), bits, tables, probes)]
    publish_snapshot(
        spark.createDataFrame(figures, "n long, mean array<double>, bits int, tables int, probes int"), f"{root}/figures"
    )
    return HashedIndex(spark, root, keys)


def candidates(index: HashedIndex, queries: DataFrame, probes: int | None = None) -> DataFrame:
    """(query_id, keys, distance) of every vector in a probed bucket, once for each table that finds it.

    It shows what a search looks into; ``hashed_topk`` itself does not form these rows.
    """
    f = index.figures
    mean = np.array(f["mean"], dtype=float)
    normals, n = planes(len(mean), f["bits"], f["tables"]), probes or f["probes"]
    asked = queries.select("query_id", F.col("embedding").cast("array<double>").alias("wanted")).filter("wanted IS NOT NULL" if f["n"] else "false")
    kind = asked.schema["query_id"].dataType.simpleString()

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            away = sides(_matrix(batch.column("wanted")), mean, normals) if batch.num_rows else np.zeros((0, 0, 0))
            for i, own in enumerate(codes(away)):
                at = np.concatenate([own[t] ^ probe_masks(away[i, t], n) for t in range(len(own))])
                row = batch.slice(i, 1).take(pa.array(np.zeros(len(at), dtype=np.int64)))
                table = pa.array(np.repeat(np.arange(len(own), dtype=np.int32), len(at) // len(own)))
                yield pa.RecordBatch.from_arrays([*row.columns, table, pa.array(at)], ["query_id", "wanted", "tbl", "code"])

    places = materialize(asked.mapInArrow(probed, f"query_id {kind}, wanted array<double>, tbl int, code long"), "probes")
    met = index.buckets.join(broadcast_if_small(places), ["tbl", "code"]).select("query_id", *index.keys, "wanted", "embedding")
    names = ["query_id", *index.keys]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gap = _matrix(batch.column("wanted")) - _matrix(batch.column("embedding"))
            far = pa.array(round_score((gap * gap).sum(axis=1)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), far], [*names, "distance"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in met.select(*names).schema)
    return met.mapInArrow(measured, f"{kinds}, distance double")


def _reaches(away: np.ndarray, n: int) -> np.ndarray:
    """For every question and table, the cost of the ``n``-th cheapest probe."""
    reach = np.zeros(away.shape[:2])
    for i, t in np.ndindex(*reach.shape):
        cost = np.sort(away[i, t] ** 2)[:ORDERED_BITS]
        sums = np.zeros(1)
        for one in cost:
            sums = np.concatenate([sums, sums + one])
        last = min(n, len(sums)) - 1
        reach[i, t] = np.partition(sums, last)[last]
    return reach * (1 + 1e-9)  # whatever the order of additions


def _bucket_scorer(mean: np.ndarray, normals: np.ndarray):
    """Negated squared distances of the vectors of each bucket to the questions that reach it, see ``search_top_k``."""

    def prepare(queries: pa.Table):
        wanted = _matrix(queries.column("wanted"))
        reach = _matrix(queries.column("reach"))
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def reaching(t: int, code: int) -> np.ndarray:
            if t not in known:
                known.clear()  # tables come in order
                away = sides(wanted, mean, normals[t : t + 1])[:, 0]
                known[t] = away > 0, away * away
            own, cost = known[t]
            bucket = (code >> np.arange(own.shape[1]) & 1).astype(bool)
            # a cost that is no number rules nothing out
            return np.flatnonzero(~((cost * (own != bucket)).sum(axis=1) > reach[:, t]))

        def score(batch):
            if not batch.num_rows or not len(wanted):
                return
            vectors = _matrix(batch.column("embedding"))
            tbl, code = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("tbl", "code"))
            order = np.lexsort((code, tbl))
            new = (np.diff(tbl[order]) != 0) | (np.diff(code[order]) != 0)
            first = [0, *(np.flatnonzero(new) + 1), len(order)]
            for at, end in zip(first, first[1:]):
                rows = order[at:end]
                asked = reaching(int(tbl[rows[0]]), int(code[rows[0]]))
                step = max(1, BLOCK_CELLS // max(1, min(len(asked), BLOCK_CELLS // 64)))
                width = max(1, BLOCK_CELLS // min(step, len(rows)))
                for start in range(0, len(rows), step):
                    some = rows[start : start + step]
                    # measured from one of them, as products of long vectors would lose the digits of a small distance
                    origin = np.where(np.isfinite(vectors[some[0]]), vectors[some[0]], 0)
                    block = vectors[some] - origin
                    of_block = (block * block).sum(axis=1)[:, None]
                    for left in range(0, len(asked), width):
                        part = asked[left : left + width]
                        sought = wanted[part] - origin
                        scores = 2 * (block @ sought.T) - of_block - (sought * sought).sum(axis=1)
                        yield some, np.where(np.isnan(scores), UNKNOWN, np.minimum(scores, 0)), part

        return queries.column("query_id").combine_chunks(), score

    return prepare


def hashed_topk(index: HashedIndex, queries: DataFrame, k: int = 15, probes: int | None = None) -> DataFrame:
    """(query_id, keys, distance, rank) of the ``k`` nearest of the vectors in the probed buckets.

    The questions travel to the buckets, which stay as they are stored, so a bucket with a third of all vectors is no
    larger a task than its files. A task scores the vectors of a bucket against the questions that probe it as one matrix and
    keeps the best of each question, so neither probes nor (question, vector) pairs are ever rows.
    """
    f = index.figures
    mean = np.array(f["mean"], dtype=float)
    normals, n = planes(len(mean), f["bits"], f["tables"]), probes or f["probes"]
    asked = queries.select("query_id", F.col("embedding").cast("array<double>").alias("wanted")).filter("wanted IS NOT NULL" if f["n"] else "false")
    kind = asked.schema["query_id"].dataType.simpleString()

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            reach = _reaches(sides(_matrix(batch.column("wanted")), mean, normals), n)
            ends = np.arange(0, reach.size + 1, reach.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(reach.ravel()))], ["query_id", "wanted", "reach"]
            )

    cores = index.spark.sparkContext.defaultParallelism
    placed = asked.repartition(cores).mapInArrow(reached, f"query_id {kind}, wanted array<double>, reach array<double>")
    hits = search_top_k(
        index.buckets, placed, index.keys, _bucket_scorer(mean, normals), k, query_limits=QUERY_LIMITS, repeated=True
    )
    distance = F.when(F.col("score") <= UNKNOWN, F.lit(float("nan"))).otherwise(F.abs("score"))
    return hits.select("query_id", *index.keys, distance.alias("distance"), "rank")
