import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tallyweir.llm import outliers
from tests.llm.common import awkward, clashing, documents, empty, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    words, lines = WORD.findall(text or ""), [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_base_counts_equal_brute_force(spark):
    texts = [sentence(i, 5 + 9 * i) for i in range(12)]
    texts += ["a b c a b c", "a a a a", "a b\na b\n\n a b\n", "a b c d a b c", ("p q r\n" * 40).strip(), "*# $ %\t&|<>"]
    rows = awkward(spark).unionByName(documents(spark, texts)).collect()
    table = spark.createDataFrame(rows, awkward(spark).schema)
    made = outliers.with_base_counts(table).select("text", *outliers.BASE, "base_failed").collect()
    assert len(made) == len(rows)
    for row in made:
        assert tuple(row)[1:] == counts(row["text"]), row["text"]


def test_junk_is_rejected_and_clean_text_kept(spark):
    clean = [sentence(i, 60 + i % 150) for i in range(120)]
    junk = [" ".join(w + "***" for w in sentence(900 + i, 90).split()) for i in range(6)]
    junk += [sentence(950 + i, 90).upper() + " ###" for i in range(6)]
    rows = outliers.quality_verdicts(documents(spark, clean + junk)).collect()
    kept = {r["doc_id"]: r["kept"] for r in rows}
    failed = {r["doc_id"] for r in rows if r["base_failed"]}
    assert all(kept[i] for i in range(120) if i not in failed)
    assert not any(kept[i] for i in range(120, 132))


def test_the_estimates_equal_those_made_in_numpy(spark):
    """The same concentration steps over all rows in memory, one group."""
    texts = [sentence(i, 55 + 3 * (i % 90)) for i in range(150)]
    texts += [" ".join(w + "$" for w in sentence(i, 70).split()) for i in range(8)]
    docs = documents(spark, texts, sources=["s"] * len(texts))
    stats = outliers.with_base_counts(docs)
    d, floor = outliers.D, np.diag([outliers._floor(i) ** 2 for i in range(outliers.D)])
    fitted = outliers.fit_groups(stats).collect()[0]
    x = np.array([[r[f"_q{i}"] for i in range(d)] for r in stats.filter("NOT base_failed").collect()], dtype=float)

    def pooled(rows):
        n, first, second = len(rows), rows.sum(0), rows.T @ rows
        # group, language and table are the same rows: pseudo-rows with the very same moments change nothing
        mean = first / n
        return mean, second / n - np.outer(mean, mean) + floor

    def distances(mean, cov):
        z = x - mean
        return np.einsum("ij,jk,ik->i", z, np.linalg.inv(cov), z)

    centre = np.median(x, axis=0)
    spread = np.maximum(1.4826 * np.median(np.abs(x - centre), axis=0), np.sqrt(np.diag(floor)))
    z = (x - centre) / spread
    norm = (z * z).sum(1)
    unit = z[norm > 0] / np.sqrt(norm[norm > 0])[:, None]
    sign = d * (unit.T @ unit) / len(x) * np.outer(spread, spread) + floor
    best = None
    for cov in (np.diag(spread**2), sign):
        mean = centre
        for _ in range(outliers.CONCENTRATION_STEPS):
            bins = np.floor(np.log1p(np.maximum(distances(mean, cov), 0)) * outliers.BINS_PER_UNIT)
            order = np.sort(bins)
            limit = order[math.ceil(len(x) * outliers.SUPPORT) - 1]
            mean, cov = pooled(x[bins <= limit])
        if best is None or np.linalg.slogdet(cov)[1] < best[0] - 1e-9:
            best = (np.linalg.slogdet(cov)[1], mean, cov)
    assert np.allclose([fitted[f"_m{i}"] for i in range(d)], best[1], rtol=1e-6)
    inverse = np.linalg.inv(best[2])
    assert np.allclose([fitted[f"_p{i}_{j}"] for i, j in outliers.PAIRS], [inverse[i, j] for i, j in outliers.PAIRS], rtol=1e-5)


def test_pooled_groups_settle_where_numpy_does(spark):
    """Three groups of two languages, drawn towards each other, iterated in memory until no row moves."""
    texts = [sentence(i, 52 + 4 * (i % 70)) for i in range(180)] + [" ".join(w + "$" for w in sentence(i, 70).split()) for i in range(9)]
    names = [("en", "a"), ("en", "b"), ("de", "a")]
    docs = documents(spark, texts).withColumn("lang", F.expr("if(doc_id % 3 = 2, 'de', 'en')"))
    docs = docs.withColumn("source", F.expr("if(doc_id % 3 = 1, 'b', 'a')"))
    stats = outliers.with_base_counts(docs)
    d, k = outliers.D, outliers.PRIOR_ROWS
    floor = np.diag([outliers._floor(i) ** 2 for i in range(d)])
    fitted = {(r["_lang"], r["_source"]): r for r in outliers.fit_groups(stats).collect()}
    rows = stats.filter("NOT base_failed").collect()
    x = {g: np.array([[r[f"_q{i}"] for i in range(d)] for r in rows if (r["_lang"], r["_source"]) == g], float) for g in names}

    def add(*sums):
        return tuple(sum(part) for part in zip(*sums))

    def towards(small, large):
        return add((small[0] + k, small[1], small[2]), (0, k * large[1] / large[0], k * large[2] / large[0]))

    def kept(g, mean, cov):
        z = x[g] - mean
        bins = np.floor(np.log1p(np.maximum(np.einsum("ij,jk,ik->i", z, np.linalg.inv(cov), z), 0)) * outliers.BINS_PER_UNIT)
        return bins <= np.sort(bins)[math.ceil(len(bins) * outliers.SUPPORT) - 1]

    ends = {g: [] for g in names}
    for start in (0, 1):
        estimates, last = {}, None
        for g in names:
            centre = np.median(x[g], axis=0)
            spread = np.maximum(1.4826 * np.median(np.abs(x[g] - centre), axis=0), np.sqrt(np.diag(floor)))
            z = (x[g] - centre) / spread
            norm = (z * z).sum(1)
            unit = z[norm > 0] / np.sqrt(norm[norm > 0])[:, None]
            sign = d * (unit.T @ unit) / len(z) * np.outer(spread, spread) + floor
            estimates[g] = (centre, sign if start else np.diag(spread**2))
        for _ in range(outliers.CONCENTRATION_STEPS):
            masks = {g: kept(g, *estimates[g]) for g in names}
            if last is not None and all((masks[g] == last[g]).all() for g in names):
                break
            last = masks
            sums = {g: (int(m.sum()), x[g][m].sum(0), x[g][m].T @ x[g][m]) for g, m in masks.items()}
            whole = add(*sums.values())
            for g in names:
                language = towards(add(*(sums[h] for h in names if h[0] == g[0])), whole)
                n, first, second = towards(sums[g], language)
                estimates[g] = (first / n, second / n - np.outer(first, first) / n**2 + floor)
        else:
            raise AssertionError("the example should settle")
        for g in names:
            ends[g].append((np.linalg.slogdet(estimates[g][1])[1], start, *estimates[g]))
    for g in names:
        _, _, mean, cov = min(ends[g], key=lambda e: e[:2])
        inverse = np.linalg.inv(cov)
        assert fitted[g]["_settled"]
        assert np.allclose([fitted[g][f"_m{i}"] for i in range(d)], mean, rtol=1e-6)
        assert np.allclose([fitted[g][f"_p{i}_{j}"] for i, j in outliers.PAIRS], [inverse[i, j] for i, j in outliers.PAIRS], rtol=1e-5)
    assert not any(r["_settled"] for r in outliers.fit_groups(stats, steps=1).collect())


def test_awkward_rows_and_columns(spark):
    table = clashing(awkward(spark))
    kept = outliers.keep_quality(table)
    assert kept.columns == table.columns
    assert outliers.quality_verdicts(table).count() == table.count()
    assert outliers.quality_verdicts(empty(spark)).count() == 0
    assert outliers.keep_quality(empty(spark)).count() == 0


def test_keeping_agrees_with_the_verdicts(spark):
    texts = [sentence(i, 30 + 2 * i) for i in range(60)]
    docs = documents(spark, texts + texts[:5])
    verdicts = {r["doc_id"] for r in outliers.quality_verdicts(docs).filter("kept").collect()}
    assert {r["doc_id"] for r in outliers.keep_quality(docs).collect()} == verdicts


def test_no_python_in_the_plan(spark):
    plan = outliers.with_base_counts(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_step_starts_few_queries(spark, monkeypatch):
    stored, measured = [], []
    real, small = outliers.materialize, outliers.is_small
    monkeypatch.setattr(outliers, "materialize", lambda df, label: stored.append(label) or real(df, label))
    monkeypatch.setattr(outliers, "is_small", lambda df: measured.append(1) or small(df))
    docs = documents(spark, [sentence(i, 60 + i) for i in range(30)])
    outliers.fit_groups(outliers.with_base_counts(docs), steps=2)
    assert stored.count("mcd-sums") <= 2 and "mcd-moved" not in stored and measured == [1]


def test_a_step_is_one_query_and_the_driver_agrees_with_the_queries(spark, monkeypatch):
    texts = [sentence(i, 52 + 4 * (i % 70)) for i in range(90)] + [" ".join(w + "$" for w in sentence(i, 70).split()) for i in range(9)]
    docs = documents(spark, texts).withColumn("lang", F.expr("if(doc_id % 3 = 2, 'de', 'en')"))
    docs = docs.withColumn("source", F.expr("if(doc_id % 3 = 1, 'b', 'a')"))
    stats = outliers.materialize(outliers.with_base_counts(docs), "test-stats")
    stored, real = [], outliers.materialize
    monkeypatch.setattr(outliers, "materialize", lambda df, label: stored.append(label) or real(df, label))
    made = {}
    for steps in (4, 30):
        stored.clear()
        made[steps] = outliers.fit_groups(stats, steps=steps).orderBy(*outliers.GROUP).collect()
        assert stored == ["mcd-centre", "mcd-spread", "mcd-start", "mcd-fit"]
    monkeypatch.setattr(outliers, "DRIVER_ROWS", 0)
    for steps in (4, 30):
        other = outliers.fit_groups(stats, steps=steps).orderBy(*outliers.GROUP).collect()
        for one, two in zip(made[steps], other, strict=True):
            assert one["_lang"] == two["_lang"] and one["_settled"] == two["_settled"]
            numbers = [c for c in one.asDict() if c[:2] in ("_m", "_p", "_l") and c != "_lang"]
            assert np.allclose([one[c] for c in numbers], [two[c] for c in numbers], rtol=1e-9, atol=1e-12)
