import re
from itertools import combinations

from tallyweir.llm import spaced_seeds
from tests.llm.common import awkward, clashing, documents, empty, sentence

ITEMS = "item_id long, text string"


def tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute(docs, items):
    """All diagonals of all pairs of texts."""
    out = {}
    for doc, text in docs:
        words = tokens(text)
        for item_id, item_text in items:
            item = tokens(item_text)
            compared = min(spaced_seeds.WINDOW, len(item))
            for d in range(-len(item), len(words) + 1):
                equal = [0 <= k + d < len(words) and words[k + d] == item[k] for k in range(len(item))]
                best = max((sum(equal[s : s + compared]) for s in range(len(item) - compared + 1)), default=0)
                allowed = compared * spaced_seeds.MAX_SUBSTITUTIONS // spaced_seeds.WINDOW
                if compared >= 9 and best >= compared - allowed:
                    key = (doc, item_id)
                    out[key] = max(out.get(key, 0), best)
    return out


def test_every_placement_of_two_substitutions_is_hit():
    window = range(spaced_seeds.WINDOW)
    for changed in [*combinations(window, 1), *combinations(window, 2)]:
        assert any(
            all(mask[c - at] == "0" for c in changed if 0 <= c - at < len(mask))
            for mask in spaced_seeds.MASKS
            for at in range(spaced_seeds.WINDOW - len(mask) + 1)
        ), changed


def test_equal_to_all_pairs_with_substitutions(spark):
    items = [(i, sentence(i + 50, 13 + 3 * i)) for i in range(8)] + [(100, sentence(58, 9)), (7, sentence(57, 34))]
    items += [(101, None), (102, ""), (103, "two words")]
    texts = []
    for i in range(8):
        passage = sentence(i + 50, 13 + 3 * i).split()
        for changes in ([], [6], [3, 9], [2, 5, 8], [0, 12], [1, 4, 7, 10]):
            changed = [f"x{k}" if k in changes else w for k, w in enumerate(passage)]
            texts.append(sentence(i, 20) + " " + " ".join(changed).upper() + ", " + sentence(i + 300, 15))
    texts += [sentence(58, 9), sentence(52, 19)[:-3], None, "", " ".join(sentence(51, 16).split()[:12])]
    made = spaced_seeds.contaminated(documents(spark, texts), spark.createDataFrame(items, ITEMS)).collect()
    assert {(r["doc_id"], r["item_id"]): r["matched"] for r in made} == brute(list(enumerate(texts)), items)
    assert len(made) > 30


def test_blocks_of_the_benchmark_give_the_same_rows(spark):
    items = spark.createDataFrame([(i, sentence(i, 20)) for i in range(20)], ITEMS)
    docs = documents(spark, [sentence(i, 20) + " " + sentence(i + 40, 30) for i in range(25)])
    whole = spaced_seeds.overlaps(docs, items).collect()
    parts = spaced_seeds.overlaps(docs, items, block_rows=50).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, parts)) and len(whole) == 20


def test_awkward_rows_and_empty_tables(spark):
    items = spark.createDataFrame([(1, sentence(5, 30)), (None, sentence(6, 30))], ITEMS)
    table = clashing(awkward(spark))
    left = spaced_seeds.remove_contaminated(table, items)
    assert left.columns == table.columns and left.count() == table.count() - 2
    none = empty(spark, ITEMS)
    assert spaced_seeds.remove_contaminated(table, none).count() == table.count()
    assert spaced_seeds.contaminated(empty(spark), items).count() == 0
    assert spaced_seeds.contaminated(table, none).count() == 0
    assert spaced_seeds.contaminated(empty(spark), none).columns == ["doc_id", "item_id", "matched", "compared"]


def test_items_of_all_lengths_with_all_placements_of_the_allowed_substitutions(spark):
    items, texts, expected = [], [], {}
    for n in range(1, 16):
        words = [f"w{n}x{k}" for k in range(n)]
        items.append((n, " ".join(words)))
        compared = min(n, spaced_seeds.WINDOW)
        allowed = compared * spaced_seeds.MAX_SUBSTITUTIONS // spaced_seeds.WINDOW
        for changes in range(allowed + 2):
            for changed in combinations(range(n), changes) if n < 13 or changes <= allowed else []:
                held = [f"y{k}" if k in changed else w for k, w in enumerate(words)]
                best = max(sum(k not in changed for k in range(s, s + compared)) for s in range(n - compared + 1))
                if best >= compared - allowed:
                    expected[len(texts), n] = best
                texts.append(" ".join(["before", *held, "after"]))
    texts += [items[6][1].rsplit(" ", 1)[0], items[5][1].rsplit(" ", 1)[0], items[5][1]]  # cut at the end
    expected |= {(len(texts) - 3, 7): 6, (len(texts) - 1, 6): 6}
    made = spaced_seeds.contaminated(documents(spark, texts), spark.createDataFrame(items, ITEMS)).collect()
    assert {(r["doc_id"], r["item_id"]): r["matched"] for r in made} == expected


def test_no_document_goes_for_a_word_that_is_a_whole_item(spark):
    passage = sentence(50, spaced_seeds.LEAST_REMOVED)
    docs = documents(spark, ["Paris is a town. Yes.", sentence(51, 40) + " " + passage + " end", sentence(52, 40)])
    items = spark.createDataFrame([(1, "Paris"), (2, "Yes."), (3, passage)], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in spaced_seeds.contaminated(docs, items).collect()} == {(0, 1), (0, 2), (1, 3)}
    assert {r["doc_id"] for r in spaced_seeds.remove_contaminated(docs, items).collect()} == {0, 2}
    assert {r["doc_id"] for r in spaced_seeds.remove_contaminated(docs, items, 1).collect()} == {2}
