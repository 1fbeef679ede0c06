"""Exact nearest-neighbour search by squared Euclidean distance for a table of query vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweir.operators.search import BLOCK_CELLS, flat_list, search_top_k


def _matrix(table, column: str = "embedding") -> np.ndarray:
    if pa.types.is_binary(table.column(column).type) or pa.types.is_large_binary(table.column(column).type):  # see ``embed``
        rows = table.column(column).to_pylist()
        return np.frombuffer(b"".join(rows), "<f8").reshape(len(rows), len(rows[0]) // 8 if rows else 0)
    items, lengths = flat_list(table.column(column))
    width = int(lengths[0]) if len(lengths) else 0
    return items.to_numpy(zero_copy_only=False).astype(float).reshape(len(lengths), width)


def distance_scorer():
    """Negated squared distances of a batch of vectors to all query vectors, see ``search_top_k``."""

    def prepare(queries: pa.Table):
        wanted = _matrix(queries)
        wanted_norm = (wanted * wanted).sum(axis=1)
        step = max(1, BLOCK_CELLS // max(1, len(wanted)))

        def score(batch):
            vectors = _matrix(batch)
            for start in range(0, len(vectors), step):
                block = vectors[start : start + step]
                if not len(wanted):
                    yield start, np.zeros((len(block), 0))
                    continue
                product = block @ wanted.T
                yield start, 2 * product - (block * block).sum(axis=1)[:, None] - wanted_norm

        return queries.column("query_id").combine_chunks(), score

    return prepare


def vector_topk(vectors: DataFrame, queries: DataFrame, keys: list[str], k: int = 15, **limits) -> DataFrame:
    """(query_id, *keys, distance, rank) of the ``k`` nearest rows of ``vectors`` (keys, embedding) to
    each row of ``queries`` (query_id, embedding); all vectors, packed or not, need the same length. Rows without a
    vector, on either side, have no distance and take no part."""
    hits = search_top_k(
        vectors.select(*keys, "embedding").filter("embedding IS NOT NULL"),
        queries.select("query_id", "embedding").filter("embedding IS NOT NULL"),
        keys,
        distance_scorer(),
        k,
        **limits,
    )
    distance = F.greatest(-F.col("score"), F.lit(0.0))
    return hits.withColumn("distance", distance).drop("score")
