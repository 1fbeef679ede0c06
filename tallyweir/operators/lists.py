"""Nearest neighbours by inverted lists, as a named alternative to the scan of all vectors.

Centroids are fitted on a bounded sample; every vector is put into the list of its nearest centroid. A question
looks into the ``probes`` lists whose centroids are nearest to it, and what it finds there is ranked by exact
distance. It then goes on to every further list that can hold a vector as near as its k-th one, by the distance
of the list's centroid less the list's radius; with fewer than k found, to all lists. The result is that of the exact
search, whatever the number of lists; ``probes`` and the sample only decide how much is scanned.

Lists are stored in order, a large one over several files. A task scores the vectors of a list against the questions that are
open for it as one matrix and keeps the best ``k`` per question, so no (question, vector) pairs are ever rows. Vectors without
any structure leave most lists open; the pairs to score then grow with vectors times questions, as in the exact search.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweir.operators.rank import top_n_per_group
from tallyweir.operators.search import BLOCK_CELLS, CELL_ROWS, SCORE_DECIMALS, flat_list, search_top_k
from tallyweir.session import materialize

SAMPLE_ROWS = 20_000
LIST_ROWS = 100  # vectors per list aimed at
MAX_LISTS = 4096
PROBES = 12
SEED = 42
ROUTED_ROWS = 1_000  # vectors measured against all centroids at once
#: Up to so many questions travel to the lists whole; more are laid out as a grid, see ``search_top_k``.
QUERY_LIMITS = (50_000, 64 * 1024 * 1024, 50_000)
#: The score of a distance that is no number, which comes last.
UNKNOWN = -1e290


@dataclass(frozen=True)
class VectorLists:
    """Stored vectors (keys, embedding, list), and the centroids and radii of the lists, by list number."""

    vectors: DataFrame
    centroids: np.ndarray
    radii: np.ndarray
    keys: list[str]


def _matrix(column) -> np.ndarray:
    items, lengths = flat_list(column)
    width = int(lengths[0]) if len(lengths) else 0
    return items.to_numpy(zero_copy_only=False).astype(float).reshape(len(lengths), width)


def _away(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Distances of all vectors (rows) to all centroids; one that is no number is infinite."""
    squares = (vectors * vectors).sum(axis=1)[:, None] + (centroids * centroids).sum(axis=1) - 2 * (vectors @ centroids.T)
    return np.nan_to_num(np.sqrt(np.maximum(squares, 0)), nan=np.inf)


def _nearest(vectors: DataFrame, centroids: np.ndarray, n: int) -> DataFrame:
    """``vectors`` (with embedding) plus ``places``, the ``n`` lists with the nearest centroids, the nearest one first."""
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)
    n = min(n, len(centroids))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROUTED_ROWS):
                part = batch.slice(start, ROUTED_ROWS)
                away = _away(_matrix(part.column("embedding")), shared.value)
                some = np.argpartition(away, n - 1, axis=1)[:, :n]
                order = np.argsort(np.take_along_axis(away, some, axis=1), axis=1, kind="stable")
                lists = np.take_along_axis(some, order, axis=1).astype(np.int32)
                ends = np.arange(0, lists.size + 1, n, dtype=np.int32)
                places = pa.ListArray.from_arrays(pa.array(ends), pa.array(lists.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, places], [*part.schema.names, "places"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema)
    return vectors.mapInArrow(placed, f"{kinds}, places array<int>")


def _runs(numbers: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Every number of the array, with the rows that hold it."""
    order = np.argsort(numbers, kind="stable")
    first = np.flatnonzero(np.diff(numbers[order], prepend=-1))
    for at, end in zip(first, [*first[1:], len(order)]):
        yield int(numbers[order[at]]), order[at:end]


def _radii(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The largest distance of each list's vectors to its centroid."""
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)

    def widest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        radii = np.full(len(shared.value), -1.0)
        for batch in batches:
            numbers = batch.column("list").to_numpy(zero_copy_only=False)
            gap = _matrix(batch.column("embedding")) - shared.value[numbers]
            np.maximum.at(radii, numbers, np.nan_to_num(np.sqrt((gap * gap).sum(axis=1)), nan=np.inf))
        used = np.flatnonzero(radii >= 0)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(radii[used])], ["list", "radius"])

    found = vectors.select("list", "embedding").mapInArrow(widest, "list int, radius double")
    radii = np.zeros(len(centroids))
    for row in found.groupBy("list").agg(F.max("radius").alias("radius")).collect():  # one number per list
        radii[row["list"]] = row["radius"]
    return radii


def build_lists(vectors: DataFrame, keys: list[str], n_lists: int | None = None, sample_rows: int = SAMPLE_ROWS) -> VectorLists:
    """Put every vector (keys, embedding) into a list; rows without a vector take no part.

    About ``sample_rows`` vectors, chosen by a hash of the keys, fit the centroids.
    """
    whole = vectors.select(*keys, F.col("embedding").cast("array<double>").alias("embedding"))
    whole = whole.filter("embedding IS NOT NULL")
    n = whole.count()
    if not n:
        return VectorLists(whole.withColumn("list", F.lit(0)), np.zeros((0, 0)), np.zeros(0), keys)
    share = min(1.0, sample_rows / n)
    sample = whole.filter(F.pmod(F.xxhash64(*keys), F.lit(1 << 40)) < int(share * (1 << 40)))
    featured = materialize(sample.select(array_to_vector("embedding").alias("features")), "list-sample")
    wanted = n_lists or max(1, min(MAX_LISTS, n // LIST_ROWS))
    # the centres begin as rows of the sample: choosing them by distance is work of the driver alone
    model: KMeansModel = KMeans(k=wanted, seed=SEED, maxIter=10, initMode="random").fit(featured)
    centroids = np.array([list(map(float, c)) for c in model.clusterCenters()])
    placed = _nearest(whole, centroids, 1).select(*keys, "embedding", F.col("places")[0].alias("list"))
    files = max(vectors.sparkSession.sparkContext.defaultParallelism, math.ceil(n / CELL_ROWS))
    # by ranges of list and key, so that a list of any size is spread; stored first, as the ranges are drawn from all rows
    placed = materialize(placed, "placed-vectors").repartitionByRange(files, "list", *keys)
    lists = materialize(placed.sortWithinPartitions("list"), "lists")
    return VectorLists(lists, centroids, _radii(lists, centroids), keys)


def _list_scorer(lists: VectorLists, further: bool):
    """Negated squared distances of the vectors to the questions that are open for their list, see ``search_top_k``.

    These are the questions with the list among their ``places``, or if ``further`` those without it whose ``bound`` (the
    squared distance of their k-th best so far, or null) the list's vectors may reach.
    """
    shared = lists.vectors.sparkSession.sparkContext.broadcast((lists.centroids, lists.radii))

    def prepare(queries: pa.Table):
        centroids, radii = shared.value
        wanted = _matrix(queries.column("embedding"))
        items, lengths = flat_list(queries.column("places"))
        places = items.to_numpy(zero_copy_only=False).reshape(len(lengths), -1) if len(items) else np.zeros((0, 1))
        if further:
            bound = queries.column("bound").to_numpy().astype(float)
            bound = np.where(np.isnan(bound), np.inf, bound + 10.0**-SCORE_DECIMALS)

        def asking(number: int) -> np.ndarray:
            if not len(wanted):
                return np.zeros(0, dtype=np.int64)
            first = (places == number).any(axis=1)
            if not further:
                return np.flatnonzero(first)
            gap = wanted - centroids[number]
            away = np.sqrt((gap * gap).sum(axis=1))
            # less what rounding may have added; a distance that is no number rules nothing out
            with np.errstate(invalid="ignore"):
                room = away - radii[number] - (away + radii[number]) * 1e-9
            least = np.maximum(np.where(np.isfinite(room), room, 0), 0) ** 2
            return np.flatnonzero(~first & (least <= bound))

        known: dict[int, np.ndarray] = {}

        def score(batch):
            vectors = _matrix(batch.column("embedding"))
            for number, rows in _runs(batch.column("list").to_numpy()):
                if number not in known:
                    known.clear()  # lists come in order
                    known[number] = asking(number)
                open_now = known[number]
                step = max(1, BLOCK_CELLS // max(1, len(open_now)))
                step = max(step, min(len(rows), 256))
                width = max(1, BLOCK_CELLS // step)
                for start in range(0, len(rows), step):
                    # measured from the centroid, as products of long vectors would lose the digits of a small distance
                    block = vectors[rows[start : start + step]] - centroids[number]
                    of_block = (block * block).sum(axis=1)[:, None]
                    for left in range(0, len(open_now), width):
                        asked = open_now[left : left + width]
                        sought = wanted[asked] - centroids[number]
                        scores = 2 * (block @ sought.T) - of_block - (sought * sought).sum(axis=1)
                        scores = np.where(np.isnan(scores), UNKNOWN, np.minimum(scores, 0))
                        if further:
                            scores[scores < -bound[asked]] = -np.inf
                        yield rows[start : start + step], scores, asked

        return queries.column("query_id").combine_chunks(), score

    return prepare


def lists_topk(
    lists: VectorLists, queries: DataFrame, k: int = 15, probes: int = PROBES, query_limits: tuple[int, int, int] = QUERY_LIMITS
) -> DataFrame:
    """(query_id, *keys, distance, rank) of the ``k`` nearest vectors of all.

    The questions travel to the lists; a list that holds a third of all vectors stays spread as it is stored.
    """
    asked = queries.select("query_id", F.col("embedding").cast("array<double>").alias("embedding")).filter("embedding IS NOT NULL")
    if len(lists.centroids):
        asked = _nearest(asked, lists.centroids, probes)
    else:
        asked = asked.withColumn("places", F.array().cast("array<int>"))
    asked = materialize(asked, "placed-questions")

    def best(questions: DataFrame, further: bool) -> DataFrame:
        return search_top_k(lists.vectors, questions, lists.keys, _list_scorer(lists, further), k, query_limits=query_limits)

    first = materialize(best(asked, False), "first-found")
    full = first.filter(F.col("rank") == k - 1).select("query_id", (-F.col("score")).alias("bound"))
    rest = best(asked.join(full, "query_id", "left"), True)
    order = [F.desc("score"), *(F.asc(key) for key in lists.keys)]
    both = top_n_per_group(first.drop("rank").unionByName(rest.drop("rank")), ["query_id"], order, k)
    distance = F.when(F.col("score") <= UNKNOWN, F.lit(float("nan"))).otherwise(F.abs("score")).alias("distance")
    return both.select("query_id", *lists.keys, distance, (F.col("rank") - 1).alias("rank"))


def recall(found: DataFrame, exact: DataFrame, keys: list[str]) -> float:
    """The share of the rows of ``exact`` (query_id, keys) that ``found`` holds."""
    hits = exact.select("query_id", *keys).join(found.select("query_id", *keys), ["query_id", *keys], "left_semi")
    return hits.count() / max(1, exact.count())
