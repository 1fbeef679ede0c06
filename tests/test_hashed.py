"""Hashed search against the exact scan: recall, the share of vectors it scores, and its measured number of probes."""

import numpy as np
import pytest

from tallyweir.operators import hashed, lists
from tallyweir.operators.vector import vector_topk
from tallyweir.plans import catalog

VECTORS = "vec_id long, embedding array<double>"


def _clustered(spark, n=4000, dims=24, centres=80, seed=5):
    rng = np.random.default_rng(seed)
    at = rng.normal(size=(centres, dims)) * 3
    rows = at[rng.integers(0, centres, n)] + rng.normal(size=(n, dims)) * 0.5
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], VECTORS)


def _asked(vectors):
    return vectors.filter("vec_id % 20 = 0").selectExpr("vec_id as query_id", "embedding")


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    vectors = _clustered(spark)
    return vectors, hashed.publish_hashed(vectors, ["vec_id"], str(tmp_path_factory.mktemp("hashed")), 10)


def test_nine_in_ten_are_found_in_a_small_part_of_clustered_vectors(spark, built):
    vectors, index = built
    asked = _asked(vectors)
    found = hashed.hashed_topk(index, asked, 10)
    assert lists.recall(found, vector_topk(vectors, asked, ["vec_id"], 10), ["vec_id"]) >= 0.9
    scored = hashed.candidates(index, asked).select("query_id", "vec_id").distinct().count()
    assert scored / (asked.count() * vectors.count()) < 0.2
    assert index.buckets.count() == vectors.count() * index.figures["tables"]


def test_all_probes_give_the_exact_result(spark, built):
    vectors, index = built
    asked = _asked(vectors).filter("query_id % 400 = 0")
    everything = 1 << index.figures["bits"]
    found = hashed.hashed_topk(index, asked, 10, probes=everything)
    exact = vector_topk(vectors, asked, ["vec_id"], 10)

    def rows(hits):
        return sorted((r["query_id"], r["rank"], r["vec_id"], round(r["distance"], 6)) for r in hits.collect())

    assert rows(found) == rows(exact)


def test_probes_come_in_the_order_of_their_cost():
    away = np.array([0.5, -0.1, 2.0, 0.3])
    masks = hashed.probe_masks(away)
    cost = [sum(away[b] ** 2 for b in range(4) if m >> b & 1) for m in masks.tolist()]
    assert sorted(masks.tolist()) == list(range(16)) and masks[0] == 0 and cost == sorted(cost)


def test_needed_probes_are_the_least_that_reach_the_target():
    rng = np.random.default_rng(2)
    asked = rng.normal(size=(60, 8))
    found = asked + rng.normal(size=(60, 8)) * 0.6
    mean, normals = np.zeros(8), hashed.planes(8, 5, 3)
    n = hashed.needed_probes(asked, found, mean, normals, 0.9)

    def share(probes):
        own, other = hashed.sides(asked, mean, normals), hashed.codes(hashed.sides(found, mean, normals))
        met = [
            any((hashed.codes(own)[i, t] ^ other[i, t]) in hashed.probe_masks(own[i, t], probes) for t in range(3)) for i in range(60)
        ]
        return np.mean(met)

    assert share(n) >= 0.9 and (n == 1 or share(n - 1) < 0.9)


def test_nulls_copies_and_empty_tables(spark, tmp_path):
    same = [(i, [1.0, 2.0]) for i in range(30)] + [(100, None), (101, [5.0, 5.0])]
    vectors = spark.createDataFrame(same, VECTORS)
    index = hashed.publish_hashed(vectors, ["vec_id"], f"{tmp_path}/a", 3)
    asked = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "query_id long, embedding array<double>")
    assert [(r["query_id"], r["vec_id"]) for r in hashed.hashed_topk(index, asked, 3).orderBy("rank").collect()] == [(1, 0), (1, 1), (1, 2)]
    assert hashed.hashed_topk(index, asked.filter("false"), 3).count() == 0
    none = hashed.publish_hashed(vectors.filter("false"), ["vec_id"], f"{tmp_path}/b", 3)
    assert hashed.hashed_topk(none, asked, 3).count() == 0


def test_no_probe_and_no_pair_is_a_row(spark, built):
    vectors, index = built
    hits = hashed.hashed_topk(index, _asked(vectors), 10)
    assert "Join" not in hits._jdf.queryExecution().executedPlan().toString()
    assert hits.groupBy("query_id", "vec_id").count().filter("count > 1").count() == 0
    assert hits.groupBy("query_id").count().filter("count <> 10").count() == 0


def test_a_vector_that_is_no_number_comes_last(spark, tmp_path):
    rows = [(i, [float(i), 0.0]) for i in range(6)] + [(9, [float("nan"), 1.0])]
    index = hashed.publish_hashed(spark.createDataFrame(rows, VECTORS), ["vec_id"], str(tmp_path), 7)
    asked = spark.createDataFrame([(1, [0.0, 0.0])], "query_id long, embedding array<double>")
    assert [r["vec_id"] for r in hashed.hashed_topk(index, asked, 7).orderBy("rank").collect()] == [0, 1, 2, 3, 4, 5, 9]


def test_the_registered_query_finds_nine_in_ten(spark):
    sf_dir = "/root/testdata/sf0.01"
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = catalog.queries()["vector_hashed_topk"](spark, sf_dir)
    assert lists.recall(found, vector_topk(vectors, _asked(vectors), ["vec_id"], 15), ["vec_id"]) >= 0.9
