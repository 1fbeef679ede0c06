"""Targets and totals against plain Python; texts of the mix against the documents; permutations on every size."""

import re
from collections import Counter
from fractions import Fraction

from pyspark.sql import functions as F

from tallyweir.llm import mixing
from tallyweir.llm.scans import running
from tests.llm.common import awkward, clashing, documents, empty, sentence


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def targets(sizes):
    """By the wording: share by weight, stop at three times the size, share the excess again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    out = {s: Fraction(0) for s in order}
    excess, active = Fraction(sum(sizes.values())), list(order)
    while excess and active:
        unit = excess / sum(weight[s] for s in active)
        for s in active:
            out[s] += unit * weight[s]
        excess = sum(max(out[s] - 3 * sizes[s], 0) for s in order)
        out = {s: min(out[s], Fraction(3 * sizes[s])) for s in order}
        active = [s for s in active if out[s] < 3 * sizes[s]]
    return out


def check(docs, near):
    rows = mixing.mix_report(docs).collect()
    given = Counter((r["doc_id"], len(words(r["text"]))) for r in docs.collect())
    assert Counter((r["doc_id"], r["size"]) for r in rows) == given
    sizes = Counter()
    for r in docs.collect():
        sizes[r["source"]] += len(words(r["text"]))
    expected = targets(sizes)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    pairs = {(r["source_size"], r["target"]) for r in rows}
    assert len(pairs) <= len(expected)
    for size, target in pairs:
        assert any(sizes[s] == size and abs(float(expected[s]) - target) < 1e-6 * (1 + target) for s in expected)
    source_of = {(r["doc_id"], r["text"]): r["source"] for r in docs.collect()}
    if len({k[0] for k in source_of}) == docs.count():
        by_id = {k[0]: s for k, s in source_of.items()}
        taken = Counter()
        for r in rows:
            taken[by_id[r["doc_id"]]] += r["taken"]
        for s, target in expected.items():
            assert abs(taken[s] - float(target)) <= near, (s, taken[s], float(target))
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.mix_report(docs).collect()))
    return rows


def test_every_source_comes_near_its_target(spark):
    texts = [sentence(i, 40 + i * 7 % 300) for i in range(240)] + ["", None, " \n\t", sentence(999, 6000)]
    sources = [("hot" if i % 3 == 0 else f"s{i % 17}" if i % 5 else None) for i in range(len(texts))]
    docs = documents(spark, texts, sources=sources)
    check(docs, near=2 * mixing.BLOCK_WORDS)


def test_small_sources_stop_at_three_times_their_words(spark):
    texts = [sentence(i, 100) for i in range(60)] + [sentence(100 + i, 30) for i in range(8)] + ["one", "two words"]
    sources = ["big"] * 60 + [f"a{i}" for i in range(8)] + ["A", "z"]
    rows = check(documents(spark, texts, sources=sources), near=2 * mixing.BLOCK_WORDS)
    assert sum(r["target"] == 3 * r["source_size"] for r in rows) >= 5
    assert all(r["taken"] == 3 * r["size"] for r in rows if r["target"] == 3 * r["source_size"])


def test_awkward_rows_clashing_columns_and_empty_tables(spark):
    docs = clashing(awkward(spark))
    check(docs.withColumn("source", F.lit(None).cast("string")), near=64)
    assert mixing.mix_report(docs).count() == docs.count()
    assert mixing.mix_report(empty(spark)).count() == 0
    blank = documents(spark, ["", None, "\n"])
    assert [tuple(r)[1:] for r in mixing.mix_report(blank).collect()] == [(0, 0, 0.0, 0)] * 3


def test_mixed_texts_hold_the_documents_words_as_often_as_taken(spark):
    texts = [sentence(i, 5 + i * 13 % 90) for i in range(80)]
    texts[7] = texts[8] = "equal texts here"
    docs = documents(spark, texts, sources=[f"s{i % 4}" for i in range(80)])
    mix = mixing.plan_mix(docs, block_words=16, shard_slots=32)
    held = mixing.mixed_texts(docs, mix).collect()
    assert len({r["slot"] for r in held}) == len(held) == mix.slots.count()
    assert {r["shard"] for r in held} == {r["slot"] // 32 for r in held}
    assert max(len(words(r["words"])) for r in held) == 16
    spans = mixing.mixed_spans(mix).collect()
    expected = Counter()
    for r in spans:
        expected.update(words(texts[r["doc_id"]])[r["first_word"] : r["first_word"] + r["n_words"]])
    assert expected == Counter(w for r in held for w in words(r["words"]))
    by_slot = {}
    for r in sorted(spans, key=lambda r: (r["slot"], r["row"])):
        by_slot.setdefault(r["slot"], []).extend(words(texts[r["doc_id"]])[r["first_word"] : r["first_word"] + r["n_words"]])
    assert {r["slot"]: " ".join(by_slot[r["slot"]]) for r in held} == {r["slot"]: r["words"] for r in held}


def test_shards_are_drawn_from_the_targets(spark):
    docs = documents(spark, [sentence(i, 400) for i in range(200)], sources=[f"s{i % 2}" for i in range(200)])
    mix = mixing.plan_mix(docs, block_words=4, shard_slots=256)
    counts = Counter((r["slot"] // 256, r["no"]) for r in mix.slots.collect())
    shares = [counts[h, 0] / 256 for h in range(mix.slots.count() // 256)]
    assert abs(sum(shares) / len(shares) - 5 / 7) < 0.01
    spread = sum((s - 5 / 7) ** 2 for s in shares) / len(shares)
    assert 0.5 < spread / (5 / 7 * 2 / 7 / 256) < 1.6  # binomial for two sources


def test_permutations(spark):
    for n in (1, 2, 3, 10, 97, 1000):
        numbers = spark.range(n).select("id", F.lit(n).cast("long").alias("n"), F.lit(5).cast("long").alias("key"))
        made = numbers.select("id", mixing.permuted(F.col("id"), F.col("n"), F.col("key")).alias("p")).collect()
        assert sorted(r["p"] for r in made) == list(range(n))
    assert sum(r["p"] == r["id"] for r in made) < 10
    assert sum(abs(r["p"] - r["id"]) < 100 for r in made) < 350


def test_running_totals_in_blocks(spark):
    rows = [(k, i, (i * 37 + k) % 11 - 5) for k in range(3) for i in range(50 * k + 1)]
    df = spark.createDataFrame(rows, "k long, i long, v long")
    for kind, combine in (("sum", lambda a, b: a + b), ("bit_xor", lambda a, b: a ^ b)):
        expected = []
        for k in range(3):
            total = 0
            for _, i, v in (r for r in rows if r[0] == k):
                expected.append((k, i, v, total))
                total = combine(total, v)
        for block in (3, 1000):
            made = running(df, ["k"], "i", {"v": kind}, block=block)
            assert sorted(map(tuple, made.collect())) == expected
