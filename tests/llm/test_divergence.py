"""All rows against plain Python with exact integers; slices, spills and pieces must not show."""

import re
from collections import Counter

import numpy as np
import pytest

from tallyweir.llm import divergence
from tests.llm.common import WORDS, awkward, clashing, documents, empty, sentence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def audit(rows, min_docs=10):
    docs, uses, groups = {}, {}, {}
    for r in rows:
        text, lang, source = (r[c] or "" for c in ("text", "lang", "source"))
        terms = Counter(TERM.findall(text.translate(LOWER)))
        docs.setdefault(lang, Counter()).update(terms.keys())
        uses.setdefault((lang, source), Counter()).update(terms)
        groups.setdefault(lang, set()).add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]

        def share(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (n + 2 * len(kept)) for t in kept}

        q = share(sum((uses[lang, s] for s in sources), Counter()))
        p = {s: share(uses[lang, s]) for s in sources}
        for a in sources:
            pairs = [(b, sum((p[a][t] - p[b][t]) ** 2 // (p[a][t] + p[b][t]) for t in kept)) for b in sources if b != a]
            terms = [(t, (p[a][t] - q[t]) ** 2 // (p[a][t] + q[t])) for t in kept if uses[lang, a][t] and p[a][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                ranked = items if part == "pair" else items[:10]
                out += [(lang, a, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)]
    return sorted(out)


def texts():
    made = [" ".join(f"{w}{'abcdefg'[(i * k) % 7]}" for k, w in enumerate(sentence(i, 30 + i % 50).split())) for i in range(160)]
    return [re.sub(r"\d+", "", t) for t in made] + ["ÀÉ É é 漢字 Straße İı", "x-y_z'w 1a2b", "", None] * 12


def table(spark):
    made = texts()
    langs = ["en" if i % 3 else (None if i % 2 else "de") for i in range(len(made))]
    sources = ["hot" if i // 6 % 2 else (None, "", "b", "é", "\U0001f600", "～")[i // 7 % 6] for i in range(len(made))]
    return documents(spark, made, langs, sources).unionByName(awkward(spark))


@pytest.mark.parametrize("spill,slices", [(divergence.SPILL_ENTRIES, divergence.SLICE_ENTRIES), (20, 7)])
def test_all_rows_equal_brute_force(spark, spill, slices):
    docs = table(spark)
    made = divergence.source_divergence(clashing(docs), spill_entries=spill, slice_entries=slices)
    assert made.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    expected = audit(docs.collect())
    assert {r[2] for r in expected} == {"pair", "term"}
    assert sorted(map(tuple, made.collect())) == expected


def test_languages_without_kept_terms_and_empty_tables(spark):
    docs = documents(spark, ["alpha beta"] * 9 + [None, "1 2 3"], ["en"] * 11, [f"s{i % 3}" for i in range(11)])
    made = divergence.source_divergence(docs).collect()
    assert sorted(map(tuple, made)) == audit(docs.collect())
    assert {r["value"] for r in made} == {0} and len(made) == 6
    assert divergence.source_divergence(empty(spark)).count() == 0


def test_long_texts_are_folded_in_pieces():
    text = (" ".join(WORDS) + "\x80é,").encode() * 300 + b"z" * 5000 + b" A end"
    for size in (1, 7, 64, 100_000):
        cut = list(divergence.pieces(text, size))
        assert b"".join(cut) == text
        assert Counter(t for c in cut for t in divergence._TERM.findall(c.lower())) == Counter(divergence._TERM.findall(text.lower()))


def test_shares_and_pair_sums_are_exact_for_large_counts():
    random = np.random.default_rng(1)
    counts = random.integers(0, 10**13, (40, 6)) * random.integers(0, 2, (40, 6))
    whole = counts.sum(axis=0) + 2 * 40
    p = [[1 + 10**9 * (int(c) + 2) // int(w) for c, w in zip(row, whole)] for row in counts]
    assert divergence.shares(counts, whole).tolist() == p
    expected = [[sum((r[a] - r[b]) ** 2 // (r[a] + r[b]) for r in p) for b in range(6)] for a in range(6)]
    assert divergence.pair_sums(counts, whole).tolist() == expected
