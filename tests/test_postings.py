"""The stored keyword index against the scan of all chunks, and what it leaves unread."""

import random

import pytest
from pyspark.sql import functions as F

from tallyweir.operators import bm25, postings

WORDS = [f"w{i}" for i in range(60)]
CHUNK = "chunk_id string, doc_id string, pos int, text string"


def _corpus(spark, seed, n=300):
    """Words of very different frequencies; the first word is in nearly every chunk, so its weight is a fixed share."""
    rng = random.Random(seed)
    weights = [1 / (i + 1) for i in range(len(WORDS))]
    rows = []
    for i in range(n):
        words = ["w0"] * (rng.random() < 0.9) + rng.choices(WORDS, weights, k=rng.randint(0, 25))
        rows.append((f"d{i // 3}_chunk_{i % 3:03d}", f"d{i // 3}", i % 3, " ".join(words)))
    rows += [(f"e{i}_chunk_000", f"e{i}", 0, "only here again only") for i in range(3)] + [("n_chunk_000", "n", 0, None)]
    return spark.createDataFrame(rows, CHUNK)


def _questions(spark):
    texts = ["w0", "w1 w1 w7", "w40 w50 W41", "only unknown", "unknown", "", None, "w0 w2 w3 w4 w59", "only w0"]
    return spark.createDataFrame(list(enumerate(texts)), "query_id long, text string")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("index"))
    return postings.publish_index(_corpus(spark, 1), root, block_chunks=10, buckets=16)


def _rows(hits):
    return sorted((r["query_id"], r["rank"], r["doc_id"], r["pos"], r["chunk_id"], round(r["score"], 6)) for r in hits.collect())


@pytest.mark.parametrize("only_positive", [False, True])
@pytest.mark.parametrize("first_terms", [1, 3])
def test_hits_equal_the_scan_of_all_chunks(spark, stored, only_positive, first_terms):
    questions = _questions(spark)
    expected = bm25.bm25_topk(bm25.bm25_index(_corpus(spark, 1)), questions, 6, only_positive)
    made = postings.stored_topk(stored, questions, 6, only_positive, first_terms)
    assert set(made.columns) == set(expected.columns)
    assert _rows(made) == _rows(expected)


def test_bounds_hold_and_blocks_are_skipped(spark, stored):
    asked = postings._asked(stored, _questions(spark).filter("query_id IN (1, 2, 7)"))
    bounds = postings.block_bounds(stored, asked)
    scores = postings._scores(stored, asked, bounds)
    rows = stored.postings.select("block", F.explode("entries").alias("e")).select("block", "e.doc_id", "e.pos").distinct()
    joined = scores.join(rows, ["doc_id", "pos"]).join(bounds, ["query_id", "block"])
    assert joined.filter("score > bound + 1e-8").isEmpty() and not joined.isEmpty()
    ranked = postings.ranked_terms(stored, asked)
    needed, figures = postings.open_terms(stored, ranked, 3)
    assert needed.count() < ranked.count()
    assert postings.open_blocks(stored, needed, figures).count() < 0.8 * bounds.count()


def test_chunks_without_a_question_word_are_not_read(spark, stored):
    asked = postings._asked(stored, spark.createDataFrame([(1, "w40 w50")], "query_id long, text string"))
    buckets = {r["bucket"] for r in asked.select("bucket").collect()}
    read = postings._folders(stored.postings, asked)
    files = [r[0] for r in read.select(F.input_file_name()).distinct().collect()]
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in files} == buckets
    scan = next(x for x in read._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x)
    assert "PartitionFilters: [bucket" in scan
    assert {r["term"] for r in postings.read_postings(stored, asked).select("term").distinct().collect()} == {"w40", "w50"}
    bounds = postings.read_postings(stored, asked).select("term", "block", "max_tf", "min_length")
    assert "entries" not in bounds._jdf.queryExecution().executedPlan().toString()


def test_no_row_holds_more_than_a_block_of_a_hot_term(spark, stored):
    sizes = stored.postings.filter("term = 'w0'").select(F.size("entries").alias("n")).collect()
    assert len(sizes) > 20 and max(r["n"] for r in sizes) < 40


def test_a_new_version_leaves_readers_alone_and_empty_tables_have_no_hits(spark, tmp_path):
    root, questions = str(tmp_path), _questions(spark)
    old = postings.publish_index(_corpus(spark, 2, 60), root, block_chunks=8, buckets=4)
    expected = bm25.bm25_topk(bm25.bm25_index(_corpus(spark, 2, 60)), questions, 4)
    reader = old.postings, old.figures, old.terms, old.chunks
    postings.publish_index(_corpus(spark, 3, 90), root, block_chunks=8, buckets=4)
    assert reader[1]["n_chunks"] == 63 and old.chunks.count() > 0
    assert _rows(postings.stored_topk(old, questions, 4, True)) == [
        r for r in _rows(expected) if r[5] > 0
    ]
    fresh = postings.StoredIndex(spark, root)
    again = bm25.bm25_topk(bm25.bm25_index(_corpus(spark, 3, 90)), questions, 4)
    assert _rows(postings.stored_topk(fresh, questions, 4)) == _rows(again)
    none = postings.publish_index(_corpus(spark, 2, 60).filter("false"), f"{root}/none")
    assert postings.stored_topk(none, questions, 4).count() == 0
    assert postings.stored_topk(fresh, questions.filter("false"), 4).count() == 0
    with pytest.raises(FileNotFoundError):
        postings.StoredIndex(spark, f"{root}/missing").postings
