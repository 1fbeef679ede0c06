import re
from collections import defaultdict

from pyspark.sql import functions as F

from tallyweir.llm import line_spread
from tests.llm.common import awkward, clashing, documents, empty, sentence


def brute(rows, min_sites):
    """Exact distinct sites of every normalised line."""
    def key(line):
        plain = re.sub(r"\s+", " ", re.sub(r"\d", "0", line.lower())).strip()
        return plain if re.search(r"[^\W_]", plain) else None

    sites, owners = defaultdict(set), defaultdict(list)
    for doc, text, site in rows:
        for line in (text or "").split("\n"):
            if text is not None and key(line):
                sites[key(line)].add(site)
                if doc is not None:
                    owners[key(line)].append(doc)
    out = []
    for doc, text, _ in rows:
        if text is None:
            out.append((doc, None))
            continue
        kept = [
            x for x in text.split("\n")
            if not key(x) or len(sites[key(x)]) < min_sites or doc == min(owners[key(x)], default=None)
        ]
        out.append((doc, "\n".join(kept)))
    return sorted(out, key=repr)


def result(docs, min_sites):
    return sorted(((r["doc_id"], r["text"]) for r in line_spread.remove_boilerplate(docs, min_sites).collect()), key=repr)


def test_equal_to_exact_counting_around_the_threshold(spark):
    texts, sources = [], []
    for i in range(60):
        lines = [sentence(i, 8)]
        lines += ["boilerplate " + "abcdefghijkl"[k] for k in range(1, 12) if i % 12 < k]
        lines += ["  COOKIE   notice 1999 " if i % 2 else "cookie notice 2024", "***"]
        texts.append("\n".join(lines + [sentence(i + 500, 5)]))
        sources.append(f"site{i % 12}")
    docs = documents(spark, texts, sources=sources)
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    for min_sites in (3, 5, 9):
        assert result(docs, min_sites) == brute(rows, min_sites)


def test_many_sites_are_estimated_by_sketches(spark):
    """A line on hundreds of sites is settled by its sketch, and a hot line stays correct."""
    docs = spark.range(600).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("same line\nown "), F.col("id").cast("string"), F.lit(" word\nhalf "), (F.col("id") % 2).cast("string")).alias("text"),
        F.lit("en").alias("lang"),
        F.concat(F.lit("s"), F.col("id")).alias("source"),
        F.lit(1).cast("long").alias("n_chars"),
    )
    rows = line_spread.remove_boilerplate(docs, 100).filter("doc_id > 99").groupBy("text").count().collect()
    # digits are all alike, so the middle lines with three of them are boilerplate, too; one document keeps its own
    assert sorted((r["text"], r["count"]) for r in rows) == [("", 499), ("own 100 word", 1)]


def test_awkward_rows(spark):
    table = clashing(awkward(spark))
    made = line_spread.remove_boilerplate(table, 2)
    assert set(table.columns) <= set(made.columns) and made.count() == table.count()
    rows = [(r["doc_id"], r["text"], r["source"]) for r in awkward(spark).collect()]
    assert result(awkward(spark), 2) == brute(rows, 2)
    assert line_spread.remove_boilerplate(empty(spark)).count() == 0
