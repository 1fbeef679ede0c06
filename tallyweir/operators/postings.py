"""A stored keyword index: postings by term with bounds per block, so that a search reads only blocks that can matter.

Up to ``BLOCK_CHUNKS`` chunks that lie together make a block, and a block's rows are made within its task, without a shuffle. The
postings of a hot term are so spread over all blocks and no row holds more than a block's. A stored row is one term in one block: its postings, and the largest
frequency and the smallest length among them, which bound what the term can add to a chunk of the block, whatever
the mean length of the corpus. Rows lie in folders by a hash of the term.

A search first looks up the question's terms; only their folders are listed. Its terms are ranked by the most that each can add to
any chunk. Then:

1. The chunks of the ``FIRST_TERMS`` strongest terms are scored by these alone. The k-th best such score is a threshold that
   the k best chunks reach.
2. Terms so weak that all of them together, from some place in the ranking on, stay below the threshold are left out: a chunk
   needs one of the others to be among the best. Nor are blocks read whose bound, with all that the weak terms could
   add, stays below it.
3. The blocks that are still open for some question are scored in full, from all asked terms' postings in them.

No step drops a chunk that could be among the best; results equal ``bm25_topk``. Blocks are scored as matrices, some of them per task,
and a task returns only what its own best leave open, so a word that is in every chunk makes no row per question and chunk.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyweir.functions.text import tokenize
from tallyweir.operators.bm25 import CHUNK_KEYS, EPSILON, K1, B, Bm25Index, added_up, bm25_index, bm25_topk, with_chunk_id
from tallyweir.operators.rank import top_n_per_group
from tallyweir.operators.search import CELL_QUERIES, CELL_ROWS, flat_list
from tallyweir.session import broadcast_if_small, materialize
from tallyweir.sources.sinks import publish_snapshot, read_snapshot

BLOCK_CHUNKS = 1024
TERM_BUCKETS = 64
FIRST_TERMS = 3
#: Scores are compared at nine decimals, so a bound must be lower than the threshold by more than that.
SLACK = 1e-8


def _bucket(term: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def gain(tf: Column, length: Column, mean_length: float, k1: float = K1, b: float = B) -> Column:
    """What one occurrence of a question term adds to a chunk's score, per unit of its weight."""
    norm = k1 * (1 - b) + k1 * b * length / F.lit(mean_length) if mean_length else F.lit(k1)
    return tf * (k1 + 1) / (tf + norm)


@dataclass(frozen=True)
class StoredIndex:
    """The published tables under ``root``: ``postings``, ``terms`` (term, df), ``chunks`` (keys, tokens), ``figures``."""

    spark: SparkSession
    root: str

    def _read(self, name: str) -> DataFrame:
        found = read_snapshot(self.spark, f"{self.root}/{name}")
        if found is None:
            raise FileNotFoundError(f"no published {name} under {self.root}")
        return found

    @cached_property
    def postings(self) -> DataFrame:
        return self._read("postings")

    @cached_property
    def chunks(self) -> DataFrame:
        return self._read("chunks")

    @cached_property
    def figures(self):
        return self._read("figures").first()

    @property
    def mean_length(self) -> float:
        return self.figures["total_tokens"] / self.figures["n_chunks"] if self.figures["n_chunks"] else 0.0

    @cached_property
    def terms(self) -> DataFrame:
        """(term, df, idf), with the idf of the corpus as it is now."""
        raw = F.log(F.lit(self.figures["n_chunks"] + 0.5) - F.col("df")) - F.log(F.col("df") + F.lit(0.5))
        low = F.lit(EPSILON * self.figures["average_idf"])
        return self._read("terms").select("bucket", "term", "df", F.when(raw < 0, low).otherwise(raw).alias("idf"))

    def scan_index(self) -> Bm25Index:
        """The same index in the form that ``bm25_topk`` scans."""
        f = self.figures
        return Bm25Index(self.chunks, self.terms.drop("bucket"), f["n_chunks"], f["total_tokens"], f["average_idf"])


def _rows(index: Bm25Index, block_chunks: int, buckets: int) -> DataFrame:
    """One row per term and block: the postings of a block are turned round where its chunks lie."""
    chunks = index.chunks.select(*CHUNK_KEYS, "tokens", F.spark_partition_id().alias("_part"))
    kinds = {f.name: f.dataType.simpleString() for f in index.chunks.schema}

    def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = 0
        for batch in batches:
            for start in range(0, batch.num_rows, block_chunks):
                part = batch.slice(start, block_chunks)
                tokens, lengths = flat_list(part.column("tokens"))
                words = tokens.dictionary_encode()
                n, rows = len(lengths), np.repeat(np.arange(len(lengths)), lengths)
                code = words.indices.to_numpy(zero_copy_only=False).astype(np.int64) * n + rows
                code, tf = np.unique(code, return_counts=True)
                term, row = code // n, (code % n).astype(np.int64)
                first = np.flatnonzero(np.diff(term, prepend=-1))
                if not len(first):
                    continue
                keys = [part.column(c).take(pa.array(row)) for c in CHUNK_KEYS]
                figures = [tf.astype(np.int32), lengths[row].astype(np.int32)]
                entry = pa.StructArray.from_arrays([*keys, *map(pa.array, figures)], [*CHUNK_KEYS, "tf", "length"])
                ends = pa.array(np.append(first, len(term)).astype(np.int32))
                number = part.column("_part")[0].as_py() * 2**32 + block
                block += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        words.dictionary.take(pa.array(term[first])),
                        pa.array(np.full(len(first), number, dtype=np.int64)),
                        pa.array(np.maximum.reduceat(figures[0], first)),
                        pa.array(np.minimum.reduceat(figures[1], first)),
                        pa.ListArray.from_arrays(ends, entry),
                    ],
                    ["term", "block", "max_tf", "min_length", "entries"],
                )

    entries = ", ".join(f"`{c}`: {kinds[c]}" for c in CHUNK_KEYS)
    schema = f"term string, block long, max_tf int, min_length int, entries array<struct<{entries}, tf: int, length: int>>"
    return chunks.mapInArrow(turned, schema).withColumn("bucket", _bucket("term", buckets))


def publish_index(
    chunks: DataFrame, root: str, block_chunks: int = BLOCK_CHUNKS, buckets: int = TERM_BUCKETS
) -> StoredIndex:
    """Index ``chunks`` (doc_id, pos, text) and publish the tables; readers of an older version are not disturbed.

    ``figures`` is published last, and holds what makes the version whole.
    """
    spark = chunks.sparkSession
    index = bm25_index(chunks)
    publish_snapshot(index.chunks, f"{root}/chunks")
    rows = _rows(replace(index, chunks=read_snapshot(spark, f"{root}/chunks")), block_chunks, buckets)
    # every task adds a file to each folder; terms are sorted within it, so that row groups can be left out by their range of terms
    publish_snapshot(rows.sortWithinPartitions("bucket", "term", "block"), f"{root}/postings", partition_by=["bucket"])
    words = index.terms.select(_bucket("term", buckets).alias("bucket"), "term", "df")
    publish_snapshot(words.repartition("bucket").sortWithinPartitions("bucket", "term"), f"{root}/terms", partition_by=["bucket"])
    figures = [(index.n_chunks, index.total_tokens, float(index.average_idf), buckets)]
    publish_snapshot(
        spark.createDataFrame(figures, "n_chunks long, total_tokens long, average_idf double, buckets int"), f"{root}/figures"
    )
    return StoredIndex(spark, root)


def _asked(index: StoredIndex, questions: DataFrame) -> DataFrame:
    """Stored (query_id, bucket, term, weight) of the questions' known words."""
    words = questions.select("query_id", F.explode(tokenize(F.col("text"))).alias("term"))
    counted = words.groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("times"))
    counted = materialize(counted.withColumn("bucket", _bucket("term", index.figures["buckets"])), "asked")
    known = _folders(index.terms, counted).join(
        broadcast_if_small(counted.select("bucket", "term").distinct()), ["bucket", "term"], "left_semi"
    )
    weighed = counted.join(broadcast_if_small(materialize(known, "known")), ["bucket", "term"])
    return materialize(weighed.select("query_id", "bucket", "term", (F.col("times") * F.col("idf")).alias("weight")), "weights")


def _folders(table: DataFrame, asked: DataFrame) -> DataFrame:
    """``table`` in the folders of the asked terms; there are no more folders than ``buckets``."""
    wanted = [r["bucket"] for r in asked.select("bucket").distinct().collect()]
    return table.filter(F.col("bucket").isin(wanted)) if wanted else table.filter("false")


def read_postings(index: StoredIndex, asked: DataFrame) -> DataFrame:
    """The stored rows of the asked terms, and no others."""
    words = asked.select("bucket", "term").distinct()
    return _folders(index.postings, asked).join(broadcast_if_small(words), ["bucket", "term"], "left_semi")


def block_bounds(index: StoredIndex, asked: DataFrame) -> DataFrame:
    """Stored (query_id, block, bound): no chunk of the block scores more for the question.

    A word of negative weight adds nothing to a bound: a chunk of the block may do without it.
    """
    rows = read_postings(index, asked).select("bucket", "term", "block", "max_tf", "min_length")
    most = F.greatest(F.col("weight") * gain(F.col("max_tf"), F.col("min_length"), index.mean_length), F.lit(0.0))
    bounds = rows.join(broadcast_if_small(asked), ["bucket", "term"]).groupBy("query_id", "block").agg(F.sum(most).alias("bound"))
    return materialize(bounds, "bounds")


def ranked_terms(index: StoredIndex, asked: DataFrame) -> DataFrame:
    """Stored ``asked`` plus ``place`` (from 1) in the question's ranking, and ``tail``: the most that a chunk scores without
    the terms before this one. A question with a negative weight has no such bound, and an infinite ``tail``."""
    rows = read_postings(index, asked).groupBy("bucket", "term").agg(F.max("max_tf").alias("max_tf"), F.min("min_length").alias("min_length"))
    known = asked.join(broadcast_if_small(materialize(rows, "term-bounds")), ["bucket", "term"])
    most = known.withColumn("most", F.col("weight") * gain(F.col("max_tf"), F.col("min_length"), index.mean_length))
    question = Window.partitionBy("query_id")
    order = question.orderBy(F.desc("most"), F.asc("term"))
    tail = F.sum("most").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    bounded = F.when(F.min("weight").over(question) < 0, F.lit(math.inf)).otherwise(tail)
    ranked = most.select("query_id", "bucket", "term", "weight", F.row_number().over(order).alias("place"), bounded.alias("tail"))
    return materialize(ranked, "ranked-terms")


def _scores(
    index: StoredIndex, asked: DataFrame, blocks: DataFrame | None = None, k: int | None = None, limits: DataFrame | None = None
) -> DataFrame:
    """(query_id, doc_id, pos, score) by the terms of ``asked`` alone, where positive; only in blocks of ``blocks`` (query_id, block)
    that some question has open, if given.

    With ``k``, pairs that are not among the ``k`` best, or are below the ``threshold`` of ``limits`` (query_id, threshold, which may
    be null or absent), need not be among them.
    """
    parts_of_entry = [*CHUNK_KEYS, "tf", "length"]  # an array each, a fraction of the size of an array of rows
    rows = read_postings(index, asked).select("term", "block", *(F.col(f"entries.{c}").alias(c) for c in parts_of_entry))
    if blocks is not None:
        rows = rows.join(broadcast_if_small(materialize(blocks.select("block").distinct(), "read-blocks")), "block", "left_semi")
    words = asked.select("query_id", "term", "weight")
    if limits is None:
        words = words.withColumn("threshold", F.lit(None).cast("double"))
    else:
        words = words.join(broadcast_if_small(limits.select("query_id", "threshold")), "query_id", "left")
    words = materialize(words, "wanted")
    parts = max(1, math.ceil(index.figures["n_chunks"] / CELL_ROWS))
    askers = max(1, math.ceil(words.select("query_id").distinct().count() / CELL_QUERIES))

    def cell(name: str, count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)

    left = rows.select("*", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int").alias("_part"), cell("_asker", askers))
    right = words.select("*", F.pmod(F.xxhash64("query_id"), F.lit(askers)).cast("int").alias("_asker"))
    right = right.select("*", cell("_part", parts))
    fields = [words.schema["query_id"], *(index.chunks.schema[c] for c in CHUNK_KEYS)]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", score double"
    mean_length, names = index.mean_length, ["query_id", *CHUNK_KEYS, "score"]

    def score(held: pa.Table, wanted: pa.Table) -> pa.Table:
        ids = wanted.column("query_id").combine_chunks()
        query_ids = pc.unique(ids)
        query = pc.index_in(ids, value_set=query_ids).to_numpy(zero_copy_only=False)
        vocabulary = pc.unique(wanted.column("term").combine_chunks())
        term = pc.index_in(wanted.column("term").combine_chunks(), value_set=vocabulary).to_numpy(zero_copy_only=False)
        by_term = np.argsort(term, kind="stable")
        weights = query[by_term], wanted.column("weight").to_numpy()[by_term], np.bincount(term, minlength=len(vocabulary))
        floor = np.full(len(query_ids), -np.inf)
        floor[query] = np.nan_to_num(wanted.column("threshold").to_numpy().astype(float), nan=-np.inf)
        held = held.filter(pc.is_in(held.column("term"), value_set=vocabulary))  # others are asked in other cells
        known = pc.index_in(held.column("term").combine_chunks(), value_set=vocabulary).to_numpy(zero_copy_only=False)
        each = {c: flat_list(held.column(c)) for c in parts_of_entry}
        keys = [each[c][0] for c in CHUNK_KEYS]
        codes = [pc.dictionary_encode(c).indices.to_numpy(zero_copy_only=False).astype(np.int64) for c in keys]
        _, at, chunk = np.unique(codes[0] * (codes[1].max(initial=0) + 1) + codes[1], return_index=True, return_inverse=True)
        order = np.argsort(chunk, kind="stable")
        tf, length = (each[c][0].to_numpy(zero_copy_only=False)[order].astype(float) for c in ("tf", "length"))
        norm = K1 * (1 - B) + K1 * B * length / mean_length if mean_length else K1
        terms = np.repeat(known, each["tf"][1])[order]
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        blocks = added_up(chunk[order], terms.astype(np.int64), tf * (K1 + 1) / (tf + norm), len(at), *weights, len(query_ids))
        for start, scores in blocks:
            scores = np.floor(scores * 1e9 + 0.5) / 1e9
            if k is not None and len(scores) >= k:
                floor = np.maximum(floor, np.partition(scores, -k, axis=0)[-k])
            row, column = np.nonzero((scores > 0) & (scores >= floor - SLACK))
            found.append((at[start + row], column, scores[row, column]))
        row, column, value = (np.concatenate(x) for x in zip(*found))
        open_still = value >= (floor - SLACK)[column]
        row, column, value = row[open_still], column[open_still], value[open_still]
        columns = [query_ids.take(pa.array(column)), *(c.take(pa.array(row)) for c in keys), pa.array(value)]
        return pa.Table.from_arrays(columns, names=names)

    return left.groupBy("_part", "_asker").cogroup(right.groupBy("_part", "_asker")).applyInArrow(score, schema)


def _thresholds(scores: DataFrame, k: int, label: str) -> DataFrame:
    """Stored (query_id, threshold): the k-th best score, for questions that have so many."""
    best = top_n_per_group(scores, ["query_id"], [F.desc("score"), *(F.asc(c) for c in CHUNK_KEYS)], k)
    return materialize(best.filter(F.col("rank") == k).select("query_id", F.col("score").alias("threshold")), label)


def _reach(bound: Column) -> Column:
    return F.col("threshold").isNull() | (bound >= F.col("threshold") - SLACK)


def open_terms(index: StoredIndex, ranked: DataFrame, k: int, first_terms: int = FIRST_TERMS) -> tuple[DataFrame, DataFrame]:
    """The terms that a chunk needs one of, and per question the threshold and what the others can add (``left``)."""
    first = ranked.filter(F.col("place") <= first_terms)
    early = broadcast_if_small(_thresholds(_scores(index, first, k=k), k, "first-thresholds"))
    judged = materialize(ranked.join(early, "query_id", "left").withColumn("needed", _reach(F.col("tail"))), "judged-terms")
    left = F.coalesce(F.max(F.when(~F.col("needed"), F.col("tail"))), F.lit(0.0)).alias("left")
    return judged.filter("needed"), materialize(judged.groupBy("query_id").agg(F.max("threshold").alias("threshold"), left), "left-over")


def open_blocks(index: StoredIndex, needed: DataFrame, figures: DataFrame) -> DataFrame:
    """Stored (query_id, block) that may hold one of the best chunks."""
    bounds = block_bounds(index, needed).join(broadcast_if_small(figures), "query_id")
    endless = needed.filter(F.col("tail") == math.inf).select("query_id").distinct().withColumn("endless", F.lit(True))
    bounds = bounds.join(broadcast_if_small(endless), "query_id", "left")
    kept = bounds.filter(F.coalesce("endless", F.lit(False)) | _reach(F.col("bound") + F.col("left")))
    return materialize(kept.select("query_id", "block"), "open-blocks")


def stored_topk(
    index: StoredIndex, questions: DataFrame, k: int = 15, only_positive: bool = False, first_terms: int = FIRST_TERMS
) -> DataFrame:
    """(query_id, doc_id, pos, score, rank, chunk_id) of the ``k`` best chunks per question, as ``bm25_topk`` gives them.

    Questions with fewer than ``k`` chunks of a positive score are filled up by a scan, unless ``only_positive`` is set.
    """
    questions = materialize(questions.select("query_id", "text"), "questions")
    asked = _asked(index, questions)
    ranked = ranked_terms(index, asked)
    needed, figures = open_terms(index, ranked, k, first_terms)
    endless = ranked.filter(F.col("tail") == math.inf).select("query_id").distinct().withColumn("endless", F.lit(True))
    # no bound by a few terms holds for an endless question; all its terms are needed
    limits = figures.join(broadcast_if_small(endless), "query_id", "left").filter("endless IS NULL").select("query_id", "threshold")
    found = materialize(_scores(index, asked, open_blocks(index, needed, figures), k, limits), "best-scores")
    best = [F.desc("score"), *(F.asc(c) for c in CHUNK_KEYS)]
    hits = top_n_per_group(found, ["query_id"], best, k)
    hits = with_chunk_id(hits.withColumn("rank", F.col("rank") - 1))
    if only_positive:
        return hits
    hits = materialize(hits, "hits")
    full = hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == k).select("query_id")
    short = materialize(questions.join(broadcast_if_small(full), "query_id", "left_anti"), "short")
    if short.isEmpty():
        return hits
    filled = bm25_topk(index.scan_index(), short, k)
    return hits.join(broadcast_if_small(full), "query_id", "left_semi").unionByName(filled.select(hits.columns))
