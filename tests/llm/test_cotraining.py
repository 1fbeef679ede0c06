import math

from pyspark.sql import functions as F

from tallyweir.llm import cotraining
from tests.llm.common import awkward, clashing, documents, empty, sentence

LABELS = "doc_id long, quality int, toxic int"


def corpus(spark):
    texts = [sentence(i, 40 + i % 60) if i % 4 else " ".join(w + "***" for w in sentence(i, 60).split()) for i in range(240)]
    return documents(spark, texts)


def test_held_out_accuracy(spark):
    docs = corpus(spark)
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(0, 240, 3)], LABELS)
    rows = cotraining.score_quality(docs, labels, rounds=2).collect()
    others = [r for r in rows if r["doc_id"] % 3]
    assert len(rows) == 240 and sum(r["kept"] == (r["doc_id"] % 4 > 0) for r in others) / len(others) > 0.95
    assert all(0 <= r[c] <= 1 for r in rows for c in ("p_text", "p_meta", "quality"))


def test_the_fit_is_bounded_and_the_scores_are_not(spark):
    docs = corpus(spark)
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(200)], LABELS)
    table = cotraining.learning_table(docs, labels)
    assert table.count() == 240 and table.filter("label is not null").count() == 200
    assert cotraining.labelled_sample(table, 60).count() < 110
    assert cotraining.score_quality(docs, labels, 60, 20, rounds=1).count() == 240


def scores(spark, odds):
    rows = [(i, i, "en" if i % 50 else "is", f"s{i % 3}", o, -o) for i, o in enumerate(odds)]
    return spark.createDataFrame(rows, "row long, _at long, lang string, source string, o_text double, o_meta double")


def test_certain_rows_equal_brute_force(spark):
    odds = [((i * 7919) % 2003 - 900) / 97 for i in range(2003)] + [90.0, -90.0, 0.0]
    table = scores(spark, odds)
    for view, values in (("text", odds), ("meta", [-o for o in odds])):
        placed = [math.floor(max(-64, min(64, o)) * 64) for o in values]
        low = sorted(placed)[math.ceil(0.2 * 0.75 * len(odds)) - 1]
        high = sorted(placed, reverse=True)[math.ceil(0.2 * 0.25 * len(odds)) - 1]
        wanted = {i: 1 for i, o in enumerate(values) if placed[i] >= high and o > 0}
        wanted |= {i: 0 for i, o in enumerate(values) if placed[i] <= low and o < 0}
        made = {r["row"]: r["label"] for r in cotraining.certain_labels(table, view, 0.2, 0.25).collect()}
        assert made == wanted
    assert cotraining.certain_labels(table.limit(0), "text", 0.2, 0.25).count() == 0


def test_the_draw_is_bounded_and_small_languages_take_part(spark):
    certain = scores(spark, [1.0] * 20000).withColumn("label", (F.col("row") % 4 == 0).cast("int"))
    drawn = cotraining.stratified_draw(certain, 1000, 0.25, "x").join(certain.select("row", "lang"), "row").collect()
    assert 800 < len(drawn) < 1200 and 150 < sum(r["label"] for r in drawn) < 350
    # one row in 50 is of the small language, which gets about a quarter of the draw
    assert 150 < sum(r["lang"] == "is" for r in drawn) < 350
    everything = cotraining.stratified_draw(certain, 10**7, 0.25, "x")
    assert everything.count() == 20000


def test_repeated_rows_are_learned_once_and_all_scored(spark):
    docs = corpus(spark)
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(0, 240, 3)], LABELS)
    copies = docs.filter("doc_id in (1, 3)")
    hot = docs
    for _ in range(20):
        hot = hot.unionByName(copies)
    hot = hot.unionByName(docs.filter("doc_id = 4").withColumn("doc_id", F.lit(3).cast("long")))
    plain = {r["doc_id"]: r["quality"] for r in cotraining.score_quality(docs, labels, rounds=1).collect()}
    table = cotraining.learning_table(hot, labels)
    assert cotraining.labelled_sample(table).count() == 81  # both texts of id 3, each once
    scored = cotraining.score_quality(docs.unionByName(copies), labels, rounds=1).collect()
    assert len(scored) == 242 and all(abs(r["quality"] - plain[r["doc_id"]]) < 1e-9 for r in scored)


def test_the_lift_is_reported_on_unseen_labels(spark):
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(0, 240, 2)], LABELS)
    alone, exchanged = sorted(cotraining.exchange_lift(corpus(spark), labels, rounds=1).collect())
    assert (alone["rounds"], exchanged["rounds"]) == (0, 1) and alone["n"] == exchanged["n"] > 10
    assert exchanged["accuracy"] > 0.9 and exchanged["log_loss"] < 0.7


def test_one_class_and_no_labels(spark):
    docs = clashing(awkward(spark))
    ones = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 0, 0), (3, 1, 0), (None, 0, 0), (4, None, 0)], LABELS)
    rows = cotraining.score_quality(docs, ones).collect()
    assert len(rows) == docs.count() and all(r["quality"] == 1 and r["kept"] for r in rows)
    rows = cotraining.score_quality(docs, empty(spark, LABELS)).collect()
    assert len(rows) == docs.count() and all(r["quality"] is None and r["kept"] for r in rows)


def test_awkward_rows_are_scored(spark):
    docs = awkward(spark).unionByName(corpus(spark).withColumn("doc_id", F.col("doc_id") + 1000))
    labels = spark.createDataFrame([(1000 + i, int(i % 4 > 0), 0) for i in range(200)], LABELS)
    assert cotraining.score_quality(docs, labels, rounds=1).count() == docs.count()
    assert cotraining.score_quality(empty(spark), labels).count() == 0
