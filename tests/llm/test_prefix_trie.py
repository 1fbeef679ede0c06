"""All nodes against a dictionary of prefixes, with narrow segments and small shards so that every kind of boundary occurs."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tallyweir.llm import prefix_trie
from tests.llm.common import clashing, empty, sentence

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append(((turn is not None, turn or 0), (role or "", text or "")))
    turns = {c: [t for _, t in sorted(ts, key=lambda x: x[0])] for c, ts in turns.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = turns.get(c - c % 100, [])[:h] + own[h:]
    return out


def expected_nodes(rows):
    members = {}
    conversations = rebuilt(rows)
    for c, said in conversations.items():
        for d in range(len(said) + 1):
            members.setdefault(tuple(said[:d]), []).append(c)
    children, total = {}, {}
    for prefix, convs in members.items():
        if prefix:
            children.setdefault(prefix[:-1], []).append(prefix)
    for prefix in sorted(members, key=len, reverse=True):
        below = [total[x] for x in children.get(prefix, [])]
        saved = (len(members[prefix]) - 1) * len(prefix[-1][1]) if prefix else 0
        total[prefix] = (sum(b[0] for b in below) if below else 1, saved + sum(b[1] for b in below))
    out = []
    for prefix, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(conversations[c]) == len(prefix))
        parent = min(members[prefix[:-1]]) if prefix else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(prefix), parent, len(convs), len(children.get(prefix, [])), *total[prefix], digest))
    return sorted(out, key=repr)


def made(spark, rows, **kwargs):
    nodes = prefix_trie.conversation_trie(clashing(spark.createDataFrame(rows, SCHEMA)), **kwargs)
    assert nodes.columns == NAMES and {t for _, t in nodes.dtypes[:7]} == {"bigint"}
    return sorted(map(tuple, nodes.collect()), key=repr)


def forest(seed, n, longest):
    """Conversations that copy the starts of others, whole copies, some very long ones and gaps in ids and turns."""
    rng = random.Random(seed)
    known, rows = [["hello"] * longest], []
    for c in sorted(rng.sample(range(3 * n), n)):
        start = rng.choice(known)
        said = start[: rng.choice([0, 1, 2, 5, len(start), len(start)])]
        said = said + [rng.choice("abcdé\U0001f600") * rng.randint(0, 4) for _ in range(rng.choice([0, 1, 3, 3, longest if rng.random() < 0.1 else 2]))]
        known.append(said)
        for i, text in enumerate(said or ["only"]):
            rows.append((c, None if i == 0 and c % 7 == 0 else 3 * i, ["user", "assistant", None][i % 3], text if c % 11 or i else None))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,width,shard_rows", [(1, 32, 4096), (2, 3, 4), (3, 2, 7)])
def test_nodes_equal_a_dictionary_of_prefixes(spark, seed, width, shard_rows):
    rows = forest(seed, 150, 3 * width if width < 9 else 70)
    expected = expected_nodes(rows)
    assert max(r[1] for r in expected) > 2 * width
    assert made(spark, rows, width=width, shard_rows=shard_rows) == expected


def test_a_third_of_all_conversations_are_copies_and_one_holds_a_third_of_all_turns(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(100, 400, 2) for t in range(4)]
    rows += [(c, t, "user", f"own {c} {t}") for c in range(401, 700, 3) for t in range(3)]
    rows += [(777, t, "user", "x") for t in range(450)]
    expected = expected_nodes(rows)
    for width, shard_rows in ((8, 16), (32, 4096)):
        assert made(spark, rows, width=width, shard_rows=shard_rows) == expected


def test_defined_cases(spark):
    rows = [
        (None, 1, "user", "belongs to none"), (5, None, None, None), (6, 1, "user", "a"), (6, 1, "user", "a"),
        (105, 1, "user", sentence(1, 5000)), (205, 1, "user", sentence(1, 5000)), (305, 1, "", ""), (405, 1, None, None),
        *((c, 0, "user", "short") for c in range(1000, 1012)),  # most have no turn left after their head
    ]
    assert made(spark, rows) == expected_nodes(rows)
    assert any(not s for s in rebuilt(rows).values())
    assert prefix_trie.conversation_trie(empty(spark, SCHEMA)).count() == 0
    assert prefix_trie.conversation_trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).count() == 0


def test_equal_turn_numbers_are_ordered_the_same_way_everywhere(spark):
    rows = [(c, 1, "user", text) for c in (48, 49, 57) for text in ("b", "a", "c", "a")]  # none takes a head
    nodes = prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA)).collect()
    again = prefix_trie.conversation_trie(spark.createDataFrame(rows[::-1], SCHEMA)).orderBy(F.rand()).collect()
    assert sorted(nodes) == sorted(again)
    assert max(r["n_convs"] for r in nodes if r["depth"] == 1) == 3
