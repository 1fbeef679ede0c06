import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyweir.functions.vectors import embed, hashing_embedder
from tallyweir.operators import bm25, lists, retrieval
from tallyweir.operators.documents import chunk_sentences, chunks_per_document, product_documents
from tallyweir.operators.vector import vector_topk

DOC = "doc_id string, title string, text string"


def _chunks(spark, *docs, size=2):
    return chunk_sentences(spark.createDataFrame(list(docs), DOC), size).orderBy("doc_id", "pos").collect()


def test_five_sentences_give_five_overlapping_chunks(spark):
    rows = _chunks(spark, ("doc1", None, "One. Two. Three. Four. Five."))
    bodies = [r["text"].removeprefix("[doc1] ") for r in rows]
    assert bodies == ["One. Two.", "Two. Three.", "Three. Four.", "Four. Five.", "Five."]
    assert all(re.fullmatch(r"doc1_chunk_\d{3}", r["chunk_id"]) and r["doc_id"] == "doc1" for r in rows)


def test_titles_blank_texts_and_sizes(spark):
    assert [r["text"] for r in _chunks(spark, ("d", "Title", "  One! Two?  "))] == ["[Title] One! Two?", "[Title] Two?"]
    assert _chunks(spark, ("d", "", " \n ")) == []
    assert [r["text"] for r in _chunks(spark, ("d", "", "One."))] == ["[d] One."]
    three = _chunks(spark, ("d", "t", "A. B. C. D. E."), size=3)
    assert [(r["pos"], r["text"]) for r in three] == [(0, "[t] A. B. C."), (2, "[t] C. D. E."), (4, "[t] E.")]
    one = _chunks(spark, ("d", "t", "A. B."), size=1)
    assert [r["text"] for r in one] == ["[t] A.", "[t] B."]
    docs = spark.createDataFrame([("d", "t", "A. B."), ("e", "t", "A.")], DOC)
    assert sorted(map(tuple, chunks_per_document(chunk_sentences(docs)).collect())) == [("d", 2), ("e", 1)]


def test_product_documents(spark):
    columns = (
        "StockCode string, Description string, total_quantity bigint, total_revenue double, num_invoices bigint, "
        "top_countries string, revenue_rank int, total_products int"
    )
    gold = spark.createDataFrame(
        [
            ("1", "LAMP", 7, 10.5, 2, "A, B", 1, 12),
            ("2", "", None, None, None, "A", 10, 12),
            ("3", " X ", 1, 1.0, 1, "A", 11, 12),
        ],
        columns,
    )
    docs = {r["doc_id"]: r for r in product_documents(gold).collect()}
    assert docs["1"]["text"].startswith("LAMP (product code 1) is a product")
    assert "total revenue of 10.50 over" in docs["1"]["text"]
    assert docs["1"]["text"].endswith("in the entire catalog.")
    assert docs["2"]["title"] == "2" and "total revenue of 0.00" in docs["2"]["text"]
    assert docs["2"]["text"].endswith("by revenue (number 10).")
    assert docs["3"]["title"] == "X" and docs["3"]["text"].endswith("It ranks 11 out of 12 products by total revenue.")
    assert product_documents(gold, max_products=1).count() == 1
    many = gold.limit(1).crossJoin(spark.range(1500)).withColumn("revenue_rank", F.col("id").cast("int") + 1).drop("id")
    assert product_documents(many).count() == 1500
    rank_one = chunk_sentences(product_documents(gold, max_products=1)).orderBy("pos").collect()
    assert len(rank_one) == 7 and rank_one[-1]["chunk_id"] == "1_chunk_006"


def _hits(spark, ids):
    rows = [(1, c, c, 0, rank) for rank, c in enumerate(ids)]
    return spark.createDataFrame(rows, "query_id int, chunk_id string, doc_id string, pos int, rank int")


def _fuse(spark, first, second, **options):
    rows = retrieval.rrf_fusion(_hits(spark, first), _hits(spark, second), **options).orderBy("rank").collect()
    return [r["chunk_id"] for r in rows], [r["score"] for r in rows]


def test_fusion_prefers_chunks_in_both_lists(spark):
    ids, scores = _fuse(spark, "AB", "AC")
    assert ids == ["A", "B", "C"]
    assert scores[0] == pytest.approx(2 / 61)
    assert scores[1] == scores[2] == pytest.approx(1 / 62)


def test_fusion_constant_and_depth(spark):
    _, scores = _fuse(spark, "A", "B", k=9)
    assert scores == [pytest.approx(0.1)] * 2
    ten = "ABCDEFGHIJ"
    assert len(_fuse(spark, ten, ten)[0]) == 6
    assert _fuse(spark, ten, "", top_k=3)[0] == ["A", "B", "C"]
    assert _fuse(spark, "AB", "CD", top_k=4)[0] == ["A", "C", "B", "D"]


def _corpus(n=400, hot=0.4, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(n):
        tokens = rng.choices(words, weights=[1 / (j + 1) for j in range(120)], k=rng.randint(1, 30))
        if rng.random() < hot:
            tokens += ["the"] * rng.randint(1, 3)
        docs.append((f"d{i % 60:02d}", i // 60, " ".join(tokens)))
    return docs


def _okapi(docs, query):
    tokens = [t.lower().split() for _, _, t in docs]
    n, mean = len(docs), sum(map(len, tokens)) / len(docs)
    df = Counter(t for ts in tokens for t in set(ts))
    idf = {t: math.log(n - c + 0.5) - math.log(c + 0.5) for t, c in df.items()}
    average = sum(idf.values()) / len(idf)
    idf = {t: 0.25 * average if v < 0 else v for t, v in idf.items()}
    scores = []
    for ts in tokens:
        tf = Counter(ts)
        scores.append(
            sum(
                idf.get(q, 0) * tf[q] * 2.5 / (tf[q] + 1.5 * (0.25 + 0.75 * len(ts) / mean))
                for q in query.lower().split()
            )
        )
    return scores


QUESTIONS = [(1, "The the w3 w90"), (2, "w0 w1 w2 w5 w110"), (3, "nothing known"), (4, "w119"), (5, "the"), (6, "")]
GRID = {"query_limits": (0, 0, 0)}


@pytest.mark.parametrize("limits", [{}, GRID], ids=["broadcast", "grid"])
@pytest.mark.parametrize("only_positive", [False, True])
def test_bm25_matches_brute_force(spark, monkeypatch, limits, only_positive):
    monkeypatch.setattr("tallyweir.operators.search.CELL_ROWS", 90)
    monkeypatch.setattr("tallyweir.operators.search.CELL_QUERIES", 2)
    docs = _corpus()
    chunks = spark.createDataFrame(docs, "doc_id string, pos int, text string").repartition(5)
    questions = spark.createDataFrame(QUESTIONS, "query_id int, text string")
    index = bm25.bm25_index(chunks)
    hits = bm25.bm25_topk(index, questions, k=7, only_positive=only_positive, **limits)
    found = {}
    for r in hits.orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["doc_id"], r["pos"], round(r["score"], 6)))
    for query_id, text in QUESTIONS:
        scores = [round(s + 1e-13, 9) for s in _okapi(docs, text)]
        order = sorted(range(len(docs)), key=lambda i: (-scores[i], docs[i][0], docs[i][1]))
        want = [(docs[i][0], docs[i][1], round(scores[i], 6)) for i in order if not only_positive or scores[i] > 0][:7]
        assert found.get(query_id, []) == want, text


def _joined_scores(index, questions):
    """The relational form of the search: question terms joined to postings, one row per match."""
    weights = bm25.question_weights(index, questions).filter("term IS NOT NULL")
    tf, length = F.col("tf"), F.col("length")
    gain = tf * (bm25.K1 + 1) / (tf + bm25.K1 * (1 - bm25.B + bm25.B * length / index.mean_length))
    joined = index.postings().join(weights, "term")
    return joined.groupBy("query_id", *bm25.CHUNK_KEYS).agg(F.sum(F.col("weight") * gain).alias("score"))


def test_words_that_are_in_every_chunk_still_give_k_hits(spark):
    """All weights are negative here, as the mean weight of the terms is."""
    chunks = spark.createDataFrame([("a", 0, "x y"), ("b", 0, "x y y"), ("c", 0, "y x x")], "doc_id string, pos int, text string")
    questions = spark.createDataFrame([(1, "x"), (2, "unknown")], "query_id int, text string")
    index = bm25.bm25_index(chunks)
    assert index.average_idf < 0
    hits = bm25.bm25_topk(index, questions, k=3).collect()
    assert sorted((h["query_id"], h["rank"]) for h in hits) == [(q, r) for q in (1, 2) for r in range(3)]
    assert all(h["score"] < 0 for h in hits if h["query_id"] == 1)
    assert bm25.bm25_topk(index, questions, k=3, only_positive=True).count() == 0


def test_bm25_pieces_and_blocks_do_not_matter(spark, monkeypatch):
    docs = _corpus(150)
    chunks = spark.createDataFrame(docs, "doc_id string, pos int, text string")
    questions = spark.createDataFrame(QUESTIONS, "query_id int, text string")
    index = bm25.bm25_index(chunks)
    whole = bm25.bm25_topk(index, questions, k=5, only_positive=True, **GRID).orderBy("query_id", "rank").collect()
    score = bm25.bm25_scorer(index.mean_length)
    query_ids, scorer = score(bm25.question_weights(index, questions).toArrow())
    batch = index.chunks.orderBy("doc_id", "pos").toArrow().combine_chunks()
    full = np.vstack([s for _, s in scorer(batch)])
    monkeypatch.setattr(bm25, "BLOCK_CELLS", 20)
    monkeypatch.setattr(bm25, "EXPANSION_PIECE", 3)
    _, small = bm25.bm25_scorer(index.mean_length)(bm25.question_weights(index, questions).toArrow())
    pieces = list(small(batch))
    assert len(pieces) > 10
    order = np.argsort(query_ids.to_numpy())
    again = np.vstack([s for _, s in pieces])
    assert np.allclose(np.sort(full[:, order], axis=1), np.sort(again, axis=1))
    relational = {(r["query_id"], r["doc_id"], r["pos"]): r["score"] for r in _joined_scores(index, questions).collect()}
    for r in whole:
        assert relational[(r["query_id"], r["doc_id"], r["pos"])] == pytest.approx(r["score"])


@pytest.mark.parametrize("limits", [{}, GRID], ids=["broadcast", "grid"])
def test_vector_search_matches_brute_force(spark, monkeypatch, limits):
    monkeypatch.setattr("tallyweir.operators.search.CELL_ROWS", 100)
    monkeypatch.setattr("tallyweir.operators.search.CELL_QUERIES", 3)
    rng = np.random.default_rng(5)
    data = rng.normal(size=(500, 8))
    data[100:250] = data[0]  # a third of all vectors are copies of one
    asked = np.vstack([data[0], rng.normal(size=(6, 8))])
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id int, embedding array<double>")
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "query_id int, embedding array<double>")
    rows = vector_topk(vectors.repartition(6), queries, ["vec_id"], 10, **limits).orderBy("query_id", "rank").collect()
    for q, wanted in enumerate(asked):
        distance = np.floor(((data - wanted) ** 2).sum(axis=1) * 1e9 + 0.5) / 1e9
        order = sorted(range(500), key=lambda i: (distance[i], i))[:10]
        assert [r["vec_id"] for r in rows if r["query_id"] == q] == order


def test_lists_find_nine_in_ten_of_the_nearest(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    asked = vectors.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    index = lists.build_lists(vectors, ["vec_id"])
    found = lists.lists_topk(index, asked, 15)
    assert index.vectors.count() == vectors.count() and len(index.centroids) > lists.PROBES
    assert lists.recall(found, vector_topk(vectors, asked, ["vec_id"], 15), ["vec_id"]) >= 0.9


def test_all_lists_give_the_exact_result(spark):
    rng = np.random.default_rng(11)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 5)))] + [(900, None)]
    vectors = spark.createDataFrame(rows, "vec_id int, embedding array<double>")
    asked = spark.createDataFrame([(i, rows[i * 7][1]) for i in range(9)] + [(99, None)], "query_id int, embedding array<double>")
    index = lists.build_lists(vectors, ["vec_id"], n_lists=6, sample_rows=100)
    exact = vector_topk(vectors, asked, ["vec_id"], 10)
    assert lists.recall(lists.lists_topk(index, asked, 10, probes=6), exact, ["vec_id"]) == 1
    assert lists.lists_topk(lists.build_lists(vectors.filter("false"), ["vec_id"]), asked).count() == 0
    assert lists.lists_topk(index, asked.filter("false")).count() == 0


def test_few_probes_of_many_lists_give_the_exact_result(spark):
    rng = np.random.default_rng(12)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(2500, 6)))]
    vectors = spark.createDataFrame(rows, "vec_id int, embedding array<double>")
    asked = spark.createDataFrame([(i, rows[i * 50][1]) for i in range(40)], "query_id int, embedding array<double>")
    index = lists.build_lists(vectors, ["vec_id"], n_lists=1000)  # under three vectors a list
    exact = vector_topk(vectors, asked, ["vec_id"], 15)
    wanted = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in exact.collect())
    for probes in (1, 12):
        found = lists.lists_topk(index, asked, 15, probes=probes)
        assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in found.collect()) == wanted


def test_no_questions_and_no_vectors(spark):
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 1.0])], "vec_id int, embedding array<double>")
    asked = spark.createDataFrame([(7, [1.0, 0.0]), (8, None)], "query_id int, embedding array<double>")
    rows = vector_topk(vectors, asked, ["vec_id"], 5).collect()
    assert sorted((r["query_id"], r["vec_id"], r["rank"]) for r in rows) == [(7, 1, 0), (7, 3, 1)]
    assert vector_topk(vectors, asked.filter("false"), ["vec_id"], 5).count() == 0
    assert vector_topk(vectors.filter("false"), asked, ["vec_id"], 5).count() == 0
    words = spark.createDataFrame([("a", 0, "x")], "doc_id string, pos int, text string")
    none = spark.createDataFrame([], "query_id int, text string")
    assert bm25.bm25_topk(bm25.bm25_index(words), none).count() == 0
    assert bm25.bm25_topk(bm25.bm25_index(words.filter("false")), none).count() == 0


def test_stages_are_made_when_they_are_read(spark, monkeypatch):
    index = retrieval.build_index(chunk_sentences(spark.createDataFrame([("7", "LAMP", "LAMP is red. It is big.")], DOC)))
    questions = spark.createDataFrame([(1, "red lamp")], "query_id int, text string")
    monkeypatch.setattr(retrieval, "rerank_topk", None)
    found = retrieval.retrieve(index, questions)
    assert found.fused.count() == 2 and "reranked" not in vars(found)


def test_expansion(spark):
    texts = ["Which is the TOP product?", "the best", "#1?", "stop it", "Number One", "laptop"]
    df = spark.createDataFrame(list(enumerate(texts)), "query_id int, text string")
    found = [r["text"] for r in retrieval.expand_query(df).orderBy("query_id").collect()]
    assert [t.endswith("by total revenue)") for t in found] == [True, True, True, True, True, False]  # "stop it" holds "top "


def test_embedding_is_stable_and_unit_length(spark):
    df = spark.createDataFrame([("red lamp",), ("lamp RED",), ("",)], "text string")
    a, b, c = [np.array(r["embedding"]) for r in embed(df, "text", hashing_embedder(16)).collect()]
    assert np.array_equal(a, b) and np.linalg.norm(a) == pytest.approx(1) and not c.any()


def test_rerank_with_own_model(spark):
    rows = [(1, f"c{i}", "d", i, i, "q", "x" * i) for i in range(5)]
    hits = spark.createDataFrame(rows, "query_id int, chunk_id string, doc_id string, pos int, rank int, question string, text string")
    longest = retrieval.pair_model(lambda: lambda qs, ts: [float(len(t)) for t in ts])
    found = retrieval.rerank_topk(hits, longest).orderBy("rank").collect()
    assert [r["chunk_id"] for r in found] == ["c4", "c3", "c2"]
    tied = retrieval.rerank_topk(hits, lambda q, t: F.lit(0.0)).orderBy("rank").collect()
    assert [r["chunk_id"] for r in tied] == ["c0", "c1", "c2"]


def test_questions_to_answers(spark):
    docs = spark.createDataFrame(
        [
            ("7", "LAMP", "LAMP is the top product by revenue: the number one. It is red."),
            ("8", "RING", "RING is small. It is cheap."),
            ("9", "BOLT", "BOLT is heavy. It is steel."),
        ],
        DOC,
    )
    index = retrieval.build_index(chunk_sentences(docs))
    questions = spark.createDataFrame([(1, "Which product is best?"), (2, "tell me about BOLT steel")], "query_id int, text string")
    answers = {r["query_id"]: r for r in retrieval.answer_questions(index, questions).collect()}
    assert answers[1]["sources"][0]["doc_id"] == "7"
    assert answers[2]["sources"][0]["doc_id"] == "9"
    assert [s["rank"] for s in answers[2]["sources"]] == [0, 1, 2]
    first = answers[2]["sources"][0]
    assert answers[2]["answer"].startswith(f"{first['text']} [Source 1] ")
    report = answers[1]["report"].split("\n")
    assert report[:3] == ["Question: Which product is best?", "", "Answer:"]
    assert report[5] == "Sources:" and report[6].startswith("  [Source 1] chunk_id=7_chunk_00") and len(report) == 9
    found = retrieval.retrieve(index, questions)
    table = retrieval.retrieval_compare({"bm25": found.bm25, "vector": found.vector}, depth=2).collect()
    assert len(table) == 4 and all(r["vector"] != "-" for r in table)


def test_comparison_fills_short_lists(spark):
    table = retrieval.retrieval_compare({"a": _hits(spark, "XYZW"), "b": _hits(spark, "Y")}).orderBy("place").collect()
    assert [tuple(r)[1:] for r in table] == [(1, "X", "Y"), (2, "Y", "-"), (3, "Z", "-")]


def test_tokens_and_vectors_of_any_white_space(spark, monkeypatch):
    """The short ways for plain texts give what the general ones do, and the places remembered are bounded."""
    import numpy as np

    from tallyweir.functions import text, vectors

    spaces = text.WHITE_SPACE
    texts = [f"A{s}b{s}{s}B c{s}" for s in spaces] + ["", " ", "  Plain text, plain  ", "İ ß É", None, "\t", "x\x00y z", "a​b c"]
    texts += [f"w{i} w{i + 1} w{i % 7}" for i in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    general = F.array_remove(F.split(F.lower("t"), rf"(?U){text.SPACE}+"), "")
    found = df.select("t", text.tokenize(F.col("t")).alias("a"), general.alias("b"))
    assert found.filter("NOT a <=> b").isEmpty()
    simple = found.filter("t = '  Plain text, plain  '").first()
    assert simple["a"] == ["plain", "text,", "plain"]
    monkeypatch.setattr(vectors, "KEPT_TOKENS", 20)
    slots = vectors._Slots(64)
    for i in range(1000):
        slots[f"w{i}"]
    assert len(slots) <= 20
    bounded = vectors.hashing_embedder()()(texts)
    monkeypatch.setattr(vectors, "KEPT_TOKENS", 10**9)
    assert (bounded == vectors.hashing_embedder()()(texts)).all() and np.isclose(np.linalg.norm(bounded[-1]), 1)
    packed = vectors.embed(df, "t", vectors.hashing_embedder(), packed=True).orderBy("i").collect()
    assert (np.array([np.frombuffer(r["embedding"], "<f8") for r in packed]) == bounded).all()
