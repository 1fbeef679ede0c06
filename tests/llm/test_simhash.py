import re

import numpy as np
import xxhash

from tallyweir.llm import simhash
from tests.llm.common import awkward, clashing, documents, empty, sentence


def reference(text, words=3):
    tokens = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))] if tokens else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(prints, radius):
    """``prints``: (id, fingerprint); the smallest id reachable over links of at most ``radius`` bits."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i][1] ^ prints[j][1]).count("1") <= radius:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(prints):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted(((doc, least.get(find(i))) for i, (doc, _) in enumerate(prints)), key=repr)


def copies(n, words):
    """Texts in groups: one, and versions of it with one word replaced."""
    out = []
    for g in range(n):
        base = sentence(g, words).split()
        out.append(" ".join(base))
        for k in range(g % 5):
            out.append(" ".join(base[: 10 + k] + [f"new{k}"] + base[11 + k :]))
    return out


def test_fingerprints_equal_the_definition(spark):
    for row in awkward(spark).collect():
        made = simhash.fingerprint((row["text"] or "").encode())
        assert int.from_bytes(made, "big") == reference(row["text"])
    assert simhash.fingerprint(sentence(1, 300).encode(), bits=256)[:8] == simhash.fingerprint(sentence(1, 300).encode())


def test_components_equal_brute_force_in_buckets_and_tiles(spark):
    texts = copies(40, 400) + ["", None, " \n"] + copies(3, 400)
    docs = documents(spark, texts).unionByName(awkward(spark))
    rows = docs.collect()
    expected = brute_components([(r["doc_id"], reference(r["text"])) for r in rows], 3)
    assert len({c for _, c in expected}) < len(rows) - 20
    for tile in (simhash.TILE, 2):
        groups = simhash.near_duplicate_groups(docs, tile=tile).collect()
        assert sorted(((g["doc_id"], g["component_id"]) for g in groups), key=repr) == expected


def test_a_chain_is_one_component_and_its_ends_need_not_be_close(spark):
    prints = [sum(1 << b for b in range(3 * k)) for k in range(20)]
    rows = [(int(p).to_bytes(8, "big"),) for p in prints]
    links = simhash.close_pairs(spark.createDataFrame(rows, "fp binary"))
    assert {r["root"] for r in simhash.components(links).collect()} == {(0).to_bytes(8, "big")}
    assert simhash.components(links).count() == 19


def test_clusters_in_large_buckets_equal_all_pairs():
    random = np.random.default_rng(3)
    centres = random.integers(0, 1 << 63, size=(6, 2), dtype=np.uint64)
    prints = centres[random.integers(0, 6, 300)]
    for i in range(300):
        for b in random.choice(128, random.integers(0, 9), replace=False):
            prints[i, b // 64] ^= np.uint64(1) << np.uint64(b % 64)
    buckets = np.sort(random.integers(0, 3, 300))
    for radius in (0, 3, 10):
        labels = simhash.cluster_buckets(buckets, prints, radius)
        expected = np.arange(300)
        changed = True
        while changed:
            changed = False
            for i in range(300):
                near = np.bitwise_count(prints ^ prints[i]).sum(axis=1) <= radius
                low = expected[near & (buckets == buckets[i])].min()
                if low < expected[i]:
                    expected[i], changed = low, True
        assert np.array_equal(labels, expected)


def test_no_all_pairs_within_a_group(spark):
    rows = [(int(1 << a | 1 << b).to_bytes(8, "big"),) for a in range(40) for b in range(a)]
    links = simhash.close_pairs(spark.createDataFrame(rows, "fp binary"), radius=4)
    assert links.count() < 30 * len(rows)
    assert simhash.components(links).select("root").distinct().count() == 1


def test_the_stage_keeps_the_smallest_id_of_each_component(spark):
    texts = copies(30, 300) + [sentence(5, 300).upper(), sentence(700, 12), sentence(700, 12) + " \n"]
    docs = documents(spark, texts)
    expected = {c for _, c in brute_components([(i, reference(t)) for i, t in enumerate(texts)], 3)}
    assert 30 < len(expected) < len(texts)
    for tile in (simhash.TILE, 2):
        assert {r["doc_id"] for r in simhash.keep_one_per_group(docs, tile=tile).collect()} == expected


def test_one_row_stays_of_repeated_rows_and_null_ids(spark):
    table = clashing(awkward(spark))
    kept = simhash.keep_one_per_group(table)
    assert kept.columns == table.columns
    texts = [r["text"] for r in kept.collect()]
    assert texts.count("one") == 1 and sum(not (t or "").split() for t in texts) == 1
    assert simhash.keep_one_per_group(empty(spark)).count() == 0
    assert simhash.simhash_components(empty(spark)).count() == 0
