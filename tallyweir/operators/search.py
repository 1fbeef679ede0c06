"""Exact top-k of every query over a whole corpus, without ever forming the pairs as rows.

Each task scores blocks of its corpus rows against the queries as a matrix and keeps only the best
``k`` rows per query, so what leaves a task is queries x k rows, however large the corpus. A second,
small step ranks the survivors of all tasks.

Query tables of a checked size are broadcast and the corpus is not shuffled at all. Larger ones are
laid out as a grid of corpus parts x query blocks, each cell of bounded size, and every cell runs the
same scoring.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweir.operators.rank import top_n_per_group
from tallyweir.session import is_small, materialize

QUERY_MAX_ROWS = 500_000
QUERY_MAX_BYTES = 64 * 1024 * 1024
MAX_QUERIES = 5_000
BLOCK_CELLS = 500_000  # scores held at once per task
PENDING_ROWS = 100_000  # found rows that a task collects, at least, before it ranks them
CELL_ROWS = 20_000  # corpus rows per grid cell
CELL_QUERIES = 1_000
SCORE_DECIMALS = 9

# Takes the query table; returns the query ids and a function from a corpus batch to score blocks:
# (rows, matrix of rows x queries), or (rows, matrix, queries) for a block of some of the queries. Rows are the number of the
# first one, or the numbers of all. Higher is better.
Scorer = Callable[[pa.RecordBatch | pa.Table], Iterator[tuple]]
Prepare = Callable[[pa.Table], tuple[pa.Array, Scorer]]


def round_score(score):
    """Scores are compared after rounding, so that the order of float additions can't decide a rank."""
    unit = 10.0**SCORE_DECIMALS
    return np.floor(score * unit + 0.5) / unit


class _Best:
    """The best rows per query seen so far: score descending, then corpus key. ``repeated`` rows count once."""

    def __init__(self, n_queries: int, k: int, keys: list[str], above: float, repeated: bool = False) -> None:
        self.k, self.keys, self.above, self.repeated = k, keys, above, repeated
        self.floor = np.full(n_queries, -np.inf)
        self.found, self.waiting = [], 0

    def offer(self, key_frame, rows, scores: np.ndarray, queries: np.ndarray | None = None) -> None:
        scores = round_score(scores)
        of = slice(None) if queries is None else queries
        row, query = np.nonzero((scores > self.above) & (scores >= self.floor[of]))
        if len(row) > self.k * scores.shape[1]:  # what is below a block's own k-th best can't be among the best
            block_floor = np.partition(scores, -self.k, axis=0)[-self.k]
            self.floor[of] = np.maximum(self.floor[of], block_floor)
            row, query = np.nonzero((scores > self.above) & (scores >= self.floor[of]))
        if not len(row):
            return
        found = key_frame.iloc[rows + row if np.ndim(rows) == 0 else rows[row]].reset_index(drop=True)
        found.insert(0, "_q", query if queries is None else queries[query])
        found.insert(1, "_s", scores[row, query])
        self.found.append(found)
        self.waiting += len(found)
        if self.waiting > max(PENDING_ROWS, self.k * len(self.floor)):
            self.rank()

    def rank(self) -> None:
        """Cut what was found down to the ``k`` best rows per query."""
        import pandas as pd

        rows = pd.concat(self.found, ignore_index=True)
        rows = rows.sort_values(["_q", "_s", *self.keys], ascending=[True, False] + [True] * len(self.keys))
        if self.repeated:
            rows = rows.drop_duplicates(["_q", *self.keys])
        place = rows.groupby("_q", sort=False).cumcount()
        self.found, self.waiting = [rows[place < self.k]], 0
        last = rows[place == self.k - 1]
        self.floor[last["_q"].to_numpy()] = last["_s"].to_numpy()

    def table(self, query_ids: pa.Array, schema: pa.Schema) -> pa.Table:
        if not self.found:
            return schema.empty_table()
        self.rank()
        rows = self.found[0]
        columns = [query_ids.take(pa.array(rows["_q"].to_numpy()))]
        columns += [pa.array(rows[key].tolist()) for key in self.keys]
        columns.append(pa.array(rows["_s"].to_numpy()))
        return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)


def _keys_of(batch, keys: list[str]):
    return batch.select(keys).to_pandas()


def search_top_k(
    corpus: DataFrame,
    queries: DataFrame,
    keys: list[str],
    prepare: Prepare,
    k: int,
    above: float = -math.inf,
    query_limits: tuple[int, int, int] = (QUERY_MAX_ROWS, QUERY_MAX_BYTES, MAX_QUERIES),
    repeated: bool = False,
) -> DataFrame:
    """(query_id, *keys, score, rank) of the ``k`` best corpus rows per query with a score over
    ``above``; rank starts at 0, ties go to the smaller key.

    ``queries`` has a ``query_id`` and whatever ``prepare`` needs; a query may span several rows. It
    is stored first, as measuring and using it would compute it several times. With ``repeated``, the corpus holds
    a key several times, each in a block of its own, and its best score counts.
    """
    queries = materialize(queries, "queries")
    max_rows, max_bytes, max_queries = query_limits
    ids = queries.select("query_id").distinct()
    if is_small(queries, max_rows, max_bytes) and is_small(ids, max_queries, max_bytes):
        hits = _scan(corpus, queries, keys, prepare, k, above, repeated)
    else:
        hits = _grid(corpus, queries, keys, prepare, k, above, repeated)
    if repeated:
        hits = hits.groupBy("query_id", *keys).agg(F.max("score").alias("score"))
    order = [F.desc("score"), *[F.asc(c) for c in keys]]
    ranked = top_n_per_group(hits, ["query_id"], order, k)
    return ranked.withColumn("rank", F.col("rank") - 1)


def _output_schema(corpus: DataFrame, queries: DataFrame, keys: list[str]):
    fields = queries.select("query_id").schema.fields + corpus.select(*keys).schema.fields
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", score double"


def _arrow_schema(frame: DataFrame):
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(frame.schema)


def _scan(corpus, queries, keys, prepare, k, above, repeated) -> DataFrame:
    schema = _output_schema(corpus, queries, keys)
    output = _arrow_schema(corpus.sparkSession.createDataFrame([], schema))
    shared = corpus.sparkSession.sparkContext.broadcast(queries.toArrow())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, scorer = prepare(shared.value)
        best = _Best(len(query_ids), k, keys, above, repeated)
        for batch in batches:
            key_frame = _keys_of(batch, keys)
            for block in scorer(batch):
                best.offer(key_frame, *block)
        yield from best.table(query_ids, output).to_batches()

    return corpus.mapInArrow(score, schema)


def _grid(corpus, queries, keys, prepare, k, above, repeated) -> DataFrame:
    schema = _output_schema(corpus, queries, keys)
    output = _arrow_schema(corpus.sparkSession.createDataFrame([], schema))
    parts = max(1, math.ceil(corpus.count() / CELL_ROWS))
    n_queries = queries.select("query_id").distinct().count()
    blocks = max(1, math.ceil(n_queries / CELL_QUERIES))

    def cell(name: str, count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)

    left = corpus.select("*", F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int").alias("_part"))
    right = queries.select("*", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("_block"))
    left = left.select("*", cell("_block", blocks))
    right = right.select("*", cell("_part", parts))

    def score(part: pa.Table, block: pa.Table) -> pa.Table:
        if not part.num_rows or not block.num_rows:
            return output.empty_table()
        query_ids, scorer = prepare(block)
        best = _Best(len(query_ids), k, keys, above, repeated)
        key_frame = _keys_of(part, keys)
        for block in scorer(part.combine_chunks()):
            best.offer(key_frame, *block)
        return best.table(query_ids, output)

    return left.groupBy("_part", "_block").cogroup(right.groupBy("_part", "_block")).applyInArrow(score, schema)


def flat_list(column) -> tuple[pa.Array, np.ndarray]:
    """(all list items in a row, list lengths) of an Arrow list column."""
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten(), pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
