"""Token counts: the pieces of each distinct pre-token are counted once and joined to the documents' pre-tokens.

A SentencePiece BPE model never merges across a place that no piece spans. The model used has no piece with a line
feed, and none with a word mark behind another character; both are tested when it is loaded. So a text, with the
blank that the model puts in front, falls into independent pre-tokens: line feeds, and runs of blanks with the
word behind them. The number of pieces of a text is the sum over its pre-tokens.

1. Pre-tokens are counted over the whole corpus, within each task first.
2. The pieces of every distinct pre-token are counted, in Arrow batches. No ids are kept.
3. Pre-tokens that make up more than one in ``COMMON`` of all are broadcast, short ones only. There are fewer than
   ``COMMON`` of them whatever the corpus, and they take in every hot key. The rest are joined by shuffle.
4. Counts are added up per document within the task before they are shuffled.

Defined results: null and empty texts have no bytes and no tokens; rows with equal id and text are counted once and
reported as often as they occur; a model whose pieces span those places is refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweir.session import broadcast_if_small, materialize

LIMIT = 4096
COMMON = 1 << 20
COMMON_BYTES = 64
MARK = "▁"

#: Blanks and literal word marks are the same to the model.
_PRE_TOKENS = rf"regexp_extract_all(concat(' ', text), '\\n|[ {MARK}]*[^ {MARK}\\n]+|[ {MARK}]+', 0)"


class PieceCounter:
    """Counts the pieces of pre-tokens with the model at ``path``."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        if any("\n" in p or MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece of this model spans a line feed or a word's start")
        if self.model.encode("a  b \n ", out_type=str)[-2:] != ["<0x0A>", MARK]:
            raise ValueError("this model does not keep white space as it is")
        self.before = len(self.model.encode("\n"))

    def counts(self, pre_tokens: list[str]) -> list[int]:
        """The pieces of each; a line feed in front keeps the model from adding its own blank."""
        encoded = self.model.encode(["\n" + p for p in pre_tokens], num_threads=1)
        return [len(ids) - self.before for ids in encoded]


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def count_pieces(pre_tokens: DataFrame, path: str) -> DataFrame:
    """``pre_tokens`` (``token``, ``uses``) plus ``pieces``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = counter(path)
        for batch in batches:
            pieces = pa.array(model.counts(batch.column(0).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, pieces], ["token", "uses", "pieces"])

    return pre_tokens.select("token", "uses").mapInArrow(run, "token string, uses long, pieces long")


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and ``key``: what tells rows of one id apart, zero where the id alone does.

    Text hashes would be a good part of all that is shuffled, so only rows with a null or repeated id get one.
    """
    repeated = materialize(
        docs.groupBy(F.col("doc_id").alias("_id")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_id"),
        "repeated-ids",
    )
    flagged = docs.select("doc_id", "text").join(
        broadcast_if_small(repeated.withColumn("_twice", F.lit(True))), F.col("doc_id") == F.col("_id"), "left"
    )
    alone = F.col("_twice").isNull() & F.col("doc_id").isNotNull()
    return flagged.select("doc_id", "text", F.when(alone, F.lit(0)).otherwise(F.xxhash64("text")).alias("key"))


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, common: int = COMMON) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit``."""
    # the outer form keeps Spark from splitting twice, for a filter on the number of pre-tokens; none is null
    every = docs.filter("text <> ''").select(F.explode_outer(F.expr(_PRE_TOKENS)).alias("token"))
    distinct = every.groupBy("token").agg(F.count(F.lit(1)).alias("uses"))
    counted = materialize(count_pieces(distinct, path), "pre-tokens")

    total = counted.agg(F.coalesce(F.sum("uses"), F.lit(0))).first()[0]
    frequent = counted.filter((F.octet_length("token") <= COMMON_BYTES) & (F.col("uses") * common > total))
    frequent = materialize(frequent.select("token", "pieces"), "common-pre-tokens")
    rows = _keyed(docs)
    tokens = rows.filter("text <> ''").select("doc_id", "key", F.explode_outer(F.expr(_PRE_TOKENS)).alias("token"))
    split = tokens.join(F.broadcast(frequent), "token", "left")
    known = split.filter("pieces IS NOT NULL").select("doc_id", "key", "pieces")
    rare = counted.join(F.broadcast(frequent.select("token")), "token", "left_anti").select("token", "pieces")
    looked_up = split.filter("pieces IS NULL").select("doc_id", "key", "token").join(rare, "token")
    parts = known.groupBy("doc_id", "key").agg(F.sum("pieces").alias("pieces")).unionByName(
        looked_up.groupBy("doc_id", "key").agg(F.sum("pieces").alias("pieces"))
    )
    sums = parts.groupBy(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).agg(F.sum("pieces").alias("pieces"))
    # equal rows have added up to one sum
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    copies = rows.groupBy("doc_id", "key").agg(F.max(size).alias("n_bytes"), F.count(F.lit(1)).alias("copies"))
    joined = copies.join(sums, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left")
    n_tokens = F.coalesce(F.expr("pieces div copies"), F.lit(0).cast("long"))
    whole = joined.select("doc_id", "n_bytes", n_tokens.alias("n_tokens"), "copies")
    repeated = whole.withColumn("_copy", F.explode(F.expr("sequence(1, cast(copies as int))")))
    return repeated.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
