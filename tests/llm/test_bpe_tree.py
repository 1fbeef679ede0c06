import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyweir.llm import bpe_tree
from tallyweir.llm.catalog import tokenizer_path
from tests.llm.common import awkward, clashing, documents, empty, sentence

PATH = tokenizer_path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
PIECES = ["a", "b", "the", "ing", "'s", "'", "'ll", " ", "  ", "\n", "\t", "1", "22", "é", "ß", "漢", "字", "😀", "=", "!!"]
PIECES += ["<|endoftext|>", "<|end", "oftext|>", "　", "́", "\xa0"]


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("leaf", [3, 16, 200])
def test_trees_equal_the_library(leaf):
    tree = bpe_tree.TreeEncoder(PATH, leaf)

    @settings(max_examples=250, deadline=None)
    @given(st.lists(st.sampled_from(PIECES), max_size=150))
    def run(pieces):
        text = "".join(pieces)
        ids = tree.encode(text)
        assert ids == library(text)
        assert tree.decode(ids).decode() == LIBRARY.decode(ids, skip_special_tokens=False) == text

    run()


@pytest.mark.parametrize("unit", ["a", "ab", "e", "=", "'", " ", "\n ", "漢字", "12", "the", "é", "'s", "ing "])
def test_long_unsplit_runs(unit):
    text = unit * (3000 // len(unit))
    for leaf in (5, 64, 1000):
        assert bpe_tree.TreeEncoder(PATH, leaf).encode(text) == library(text)


def test_windows_stay_small_at_a_join():
    tree = bpe_tree.TreeEncoder(PATH, 4096)
    text = sentence(1, 4000)
    sizes, plain = [], tree.plain
    parts = [plain(text[:9001]), plain(text[9001:])]
    tree.plain = lambda t: sizes.append(len(t)) or plain(t)
    assert tree.join(*parts) == library(text) and max(sizes) < 500


def test_segments_over_several_tasks_equal_the_library(spark):
    texts = [sentence(i, 30 * i) for i in range(25)] + ["x" * 5000, "é" * 3001, None, ""]
    docs = documents(spark, texts).unionByName(awkward(spark))
    made = bpe_tree.encode_documents(docs, PATH, leaf_chars=100, segment_chars=700).collect()
    expected = [(r["doc_id"], np.array(library(r["text"]), dtype="<u4").tobytes()) for r in docs.collect()]
    assert sorted(((r["doc_id"], bytes(r["ids"])) for r in made), key=repr) == sorted(expected, key=repr)


def test_digests_and_decoding(spark):
    docs = awkward(spark)
    made = bpe_tree.encoding_digests(clashing(docs), PATH).collect()
    expected = []
    for row in docs.collect():
        ids = library(row["text"])
        packed = np.array(ids, dtype="<u4").tobytes()
        decoded = LIBRARY.decode(ids, skip_special_tokens=False).encode()
        expected.append(
            (row["doc_id"], len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest())
        )
    assert sorted(map(tuple, made), key=repr) == sorted(expected, key=repr)
    texts = bpe_tree.decode_documents(bpe_tree.encode_documents(docs, PATH), PATH).collect()
    assert sorted(t["text"] for t in texts) == sorted(r["text"] or "" for r in docs.collect())
    assert bpe_tree.encoding_digests(empty(spark), PATH).count() == 0


def test_incomplete_characters_become_replacement_characters():
    tree = bpe_tree.TreeEncoder(PATH)
    for ids in (library("漢字")[:-1], library("😀")[1:], [*library("é")[:1], *library("ab")]):
        assert tree.decode(ids).decode() == LIBRARY.decode(ids, skip_special_tokens=False)


def test_all_characters_are_classed_as_the_library_classes_them():
    tree = bpe_tree.TreeEncoder(PATH)
    chars = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    for low in range(0, len(chars), 64):
        text = "".join(f"a{c}b 1{c}2 {c}{c}" for c in chars[low : low + 64])
        assert tree.plain(text) == library(text), hex(low)
