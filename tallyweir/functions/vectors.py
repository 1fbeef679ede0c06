"""The embedding slot, and the stand-in embedder used where no model is installed."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Embedder = Callable[[Sequence[str]], np.ndarray]
KEPT_TOKENS = 100_000  # places that a task remembers; the tokens of a large corpus have no bound


def embed(
    df: DataFrame, text: str, load: Callable[[], Embedder], output: str = "embedding", packed: bool = False
) -> DataFrame:
    """Add a vector column from a text column.

    ``load`` runs once per worker task and returns a function from a batch of texts to a matrix with
    one row per text, so a model is read once and then applied to Arrow batches. ``packed`` vectors are the bytes of their
    doubles, which are stored and read as a whole and not number by number.
    """

    @F.arrow_udf("binary" if packed else "array<double>")
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = load()
        for batch in batches:
            matrix = np.ascontiguousarray(model(batch.to_pylist()), dtype=float)
            rows, dims = matrix.shape
            if packed:
                yield pa.array([row.tobytes() for row in matrix.astype("<f8", copy=False)], pa.binary())
                continue
            ends = np.arange(0, rows * dims + 1, dims, dtype=np.int32) if rows else np.zeros(1, np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.ravel()))

    return df.withColumn(output, vectors(F.col(text)))


class _Slots(dict):
    """Dimension + 1 of each of the tokens last seen, negative for a negative sign."""

    def __init__(self, dims: int) -> None:
        super().__init__()
        self.dims = dims

    def __missing__(self, token: str) -> int:
        if len(self) >= KEPT_TOKENS:
            self.clear()
        digest = hashlib.md5(token.encode()).hexdigest()
        place = int(digest[:8], 16) % self.dims + 1
        self[token] = place if digest[8] < "8" else -place
        return self[token]


def hashing_embedder(dims: int = 64) -> Callable[[], Embedder]:
    """Unit-length bag-of-words vectors by feature hashing: shared words count, meaning does not.

    The MD5 of a token picks its dimension (first 8 hex digits) and its sign (the ninth).
    """

    def load() -> Embedder:
        slots = _Slots(dims)

        def model(texts: Sequence[str]) -> np.ndarray:
            tokens = [(text or "").lower().split() for text in texts]
            rows = np.repeat(np.arange(len(texts)), [len(t) for t in tokens])
            places = np.fromiter((slots[t] for t in chain.from_iterable(tokens)), np.int64, len(rows))
            cells = rows * dims + np.abs(places) - 1
            sums = np.bincount(cells, weights=np.sign(places), minlength=len(texts) * dims)
            matrix = sums.reshape(len(texts), dims).astype(float)
            norms = np.linalg.norm(matrix, axis=1, keepdims=True)
            return np.divide(matrix, norms, out=matrix, where=norms > 0)

        return model

    return load
