"""From ranked hit lists to cited answers, for a whole table of questions at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweir.functions.text import tokenize
from tallyweir.functions.vectors import Embedder, embed, hashing_embedder
from tallyweir.operators.bm25 import CHUNK_KEYS, Bm25Index, bm25_index, bm25_topk, with_chunk_id
from tallyweir.operators.rank import top_n_per_group
from tallyweir.operators.vector import vector_topk
from tallyweir.session import broadcast_if_small, materialize

# Fusion constant, search depths, and the expansion trigger words and text.
RRF_K = 60
SEARCH_DEPTH = 15
FUSED_DEPTH = 12
ANSWER_DEPTH = 3
SUPERLATIVES = ("top ", "best", "highest", "number one", "#1")
EXPANSION = " (the number one best-selling highest-revenue product, ranks 1 by total revenue)"


def expand_query(questions: DataFrame, column: str = "text") -> DataFrame:
    """Questions that ask for a superlative get the words that rank-1 documents use."""
    lowered = F.lower(F.col(column))
    asked = reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(word)) for word in SUPERLATIVES])
    return questions.withColumn(column, F.when(asked, F.concat(column, F.lit(EXPANSION))).otherwise(F.col(column)))


def rrf_fusion(first: DataFrame, second: DataFrame, k: int = RRF_K, top_k: int = 6) -> DataFrame:
    """Reciprocal rank fusion of two hit lists (query_id, chunk_id, doc_id, pos, rank from 0).

    A chunk scores 1 / (k + rank + 1) in each list it is in. Ties go to the better rank in the first
    list, then in the second. Input and output are a few rows per question.
    """
    columns = ["query_id", "chunk_id", "doc_id", "pos", "rank"]
    both = (
        first.select(*columns, F.lit(1).alias("_list"))
        .unionByName(second.select(*columns, F.lit(2).alias("_list")))
        .groupBy("query_id", "chunk_id", "doc_id", "pos")
        .agg(
            F.min(F.when(F.col("_list") == 1, F.col("rank"))).alias("first_rank"),
            F.min(F.when(F.col("_list") == 2, F.col("rank"))).alias("second_rank"),
        )
    )
    share = lambda rank: F.coalesce(F.lit(1.0) / (F.col(rank) + F.lit(k + 1)), F.lit(0.0))
    scored = both.withColumn("score", share("first_rank") + share("second_rank"))
    order = [F.desc("score"), F.asc_nulls_last("first_rank"), F.asc_nulls_last("second_rank")]
    ranked = top_n_per_group(scored, ["query_id"], order, top_k)
    return ranked.withColumn("rank", F.col("rank") - 1)


def with_texts(hits: DataFrame, chunks: DataFrame, questions: DataFrame) -> DataFrame:
    """Add the chunk's ``text`` and the question's ``question`` to each hit.

    The hits are a few rows per question, so they travel to the chunks, not the other way round.
    """
    texts = chunks.select(*CHUNK_KEYS, "text")
    asked = questions.select("query_id", F.col("text").alias("question"))
    found = texts.join(broadcast_if_small(hits), CHUNK_KEYS)
    return found.join(broadcast_if_small(asked), "query_id")


def term_coverage(question: Column, text: Column) -> Column:
    """Share of the question's distinct words that the text holds.

    The stand-in for a trained pair model, which isn't available here; it is not equivalent to one.
    """
    wanted = F.array_distinct(tokenize(question))
    shared = F.size(F.array_intersect(wanted, tokenize(text)))
    return F.when(F.size(wanted) > 0, shared / F.size(wanted)).otherwise(F.lit(0.0))


def pair_model(load: Callable[[], Callable[[list[str], list[str]], list[float]]]):
    """A scorer for ``rerank_topk`` from a model of (question, text) pairs, loaded once per task."""

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = load()
        for question, text in batches:
            yield pd.Series(model(question.tolist(), text.tolist()), index=question.index, dtype=float)

    return score


def rerank_topk(
    hits: DataFrame, scorer: Callable[[Column, Column], Column] = term_coverage, k: int = ANSWER_DEPTH
) -> DataFrame:
    """The ``k`` best hits (with ``question`` and ``text``) per question by the pair score; ties keep
    the order of the incoming ranks."""
    scored = hits.withColumn("pair_score", scorer(F.col("question"), F.col("text"))).withColumnRenamed(
        "rank", "fused_rank"
    )
    order = [F.desc("pair_score"), F.asc("fused_rank")]
    ranked = top_n_per_group(scored, ["query_id"], order, k)
    return ranked.withColumn("rank", F.col("rank") - 1)


def compose_answer(hits: DataFrame, questions: DataFrame) -> DataFrame:
    """(query_id, question, answer, sources, report) from each question's few best chunks.

    The answer strings the chunk texts together, each with its [Source n]; the report adds the
    question and a line per source.
    """
    cited = hits.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "chunk_id", "doc_id", "text"))).alias("sources")
    )

    def number(source: Column) -> Column:
        return F.concat(F.lit("[Source "), (source["rank"] + 1).cast("string"), F.lit("]"))

    body = F.array_join(
        F.transform("sources", lambda s: F.concat(s["text"], F.lit(" "), number(s))), " "
    )
    line = lambda s: F.concat(
        F.lit("  "),
        number(s),
        F.lit(" chunk_id="),
        s["chunk_id"],
        F.lit(" doc_id="),
        s["doc_id"],
        F.lit(' text="'),
        s["text"],
        F.lit('"'),
    )
    asked = questions.select("query_id", F.col("text").alias("question"))
    full = asked.join(cited, "query_id", "left").withColumn(
        "sources",
        F.coalesce(
            "sources",
            F.array().cast("array<struct<rank:int,chunk_id:string,doc_id:string,text:string>>"),
        ),
    )
    answered = full.withColumn("answer", body)
    report = F.concat_ws(
        "\n",
        F.concat(
            F.lit("Question: "), F.col("question"), F.lit("\n\nAnswer:\n"), F.col("answer"), F.lit("\n\nSources:")
        ),
        F.transform("sources", line),
    )
    return answered.select("query_id", "question", "answer", "sources", report.alias("report"))


def retrieval_compare(stages: dict[str, DataFrame], depth: int = 3) -> DataFrame:
    """One row per question and place, one column per stage with the chunk id at that place or '-'."""
    parts = [
        hits.filter(F.col("rank") < depth).select("query_id", "rank", "chunk_id", F.lit(name).alias("_stage"))
        for name, hits in stages.items()
    ]
    names = list(stages)
    table = (
        reduce(DataFrame.unionByName, parts)
        .groupBy("query_id", (F.col("rank") + 1).alias("place"))
        .pivot("_stage", names)
        .agg(F.min("chunk_id"))
    )
    return table.select("query_id", "place", *[F.coalesce(F.col(n), F.lit("-")).alias(n) for n in names])


@dataclass(frozen=True)
class RetrievalIndex:
    """Stored chunks with their packed vectors, and the keyword index over them."""

    chunks: DataFrame
    keywords: Bm25Index
    load_embedder: Callable[[], Embedder]


def build_index(chunks: DataFrame, load_embedder: Callable[[], Embedder] | None = None) -> RetrievalIndex:
    """Embed and store the chunks (chunk_id, doc_id, pos, text) and build the keyword index."""
    load_embedder = load_embedder or hashing_embedder()
    stored = materialize(embed(chunks, "text", load_embedder, packed=True), "chunks")
    return RetrievalIndex(stored, bm25_index(stored), load_embedder)


@dataclass(frozen=True)
class Retrieval:
    """The hit lists of every stage for one question table. A stage is made and stored when it is first read;
    the lists hold a few rows per question."""

    index: RetrievalIndex
    questions: DataFrame
    scorer: Callable[[Column, Column], Column]

    @cached_property
    def asked(self) -> DataFrame:
        return materialize(expand_query(self.questions), "questions")

    @cached_property
    def vector(self) -> DataFrame:
        query_vectors = embed(self.asked, "text", self.index.load_embedder)
        nearest = vector_topk(self.index.chunks, query_vectors, CHUNK_KEYS, SEARCH_DEPTH)
        return materialize(with_chunk_id(nearest), "vector_hits")

    @cached_property
    def bm25(self) -> DataFrame:
        return materialize(bm25_topk(self.index.keywords, self.asked, SEARCH_DEPTH), "keyword_hits")

    @cached_property
    def fused(self) -> DataFrame:
        return materialize(rrf_fusion(self.vector, self.bm25, top_k=FUSED_DEPTH), "fused_hits")

    @cached_property
    def reranked(self) -> DataFrame:
        ranked = rerank_topk(with_texts(self.fused, self.index.chunks, self.asked), self.scorer)
        return materialize(ranked, "reranked_hits")


def retrieve(
    index: RetrievalIndex, questions: DataFrame, scorer: Callable[[Column, Column], Column] = term_coverage
) -> Retrieval:
    """Both searches, fusion and reranking, all of them with the expanded questions."""
    return Retrieval(index, questions, scorer)


def answer_questions(index: RetrievalIndex, questions: DataFrame) -> DataFrame:
    """Cited answers; they show the question as it was asked, not as it was expanded."""
    return compose_answer(retrieve(index, questions).reranked, questions)
