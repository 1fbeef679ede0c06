"""Byte-level BPE encoding by tree concatenation, and decoding.

A text is cut into leaves regardless of word ends. Leaves are encoded on their own, and neighbours are joined
pairwise up a tree. At a join only a window of tokens on both sides is encoded again. The window grows until
both of its ends agree with the sides, which holds at an end if

* the window reaches a *hard boundary*, a place between two characters that no pre-token can span, whatever
  stands around it, so that everything beyond it is encoded the same in the window and in its side; or
* the window ends within one long run of letters or of digits, which is a single pre-token, and the pair of tokens
  at the seam is what BPE makes of the pair's own bytes. A sequence of BPE tokens is the encoding of its text
  exactly if each adjacent pair is the encoding of the pair's text; or
* the window takes in the whole side.

Texts beyond ``SEGMENT_CHARS`` are dealt out as segments to as many tasks, and joined again per document; the
leaves within a segment and all shorter texts are joined where they are.

The vocabulary is read from a tokenizer file of the tokenizers library (byte-level BPE, its default pre-tokenizer
pattern, one special token that is matched in texts). ``tests/llm`` compares the ids with that library's.

Defined results: a null text is encoded as the empty text; ids may be null or repeated.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF_CHARS = 4096
SEGMENT_CHARS = 32768
FIRST_WINDOW = 32

# The pre-tokenizer pattern of byte-level BPE vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable bytes as themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class TreeEncoder:
    """Encodes and decodes with the vocabulary at ``path``."""

    def __init__(self, path: str, leaf_chars: int = LEAF_CHARS):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_letters()
        vocabulary = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {
            bytes(letters[c] for c in token): i for token, i in vocabulary.items() if token not in self.special
        }
        merged = [m if isinstance(m, str) else " ".join(m) for m in spec["model"]["merges"]]
        ids = [vocabulary[m.replace(" ", "")] for m in merged]
        if ids != sorted(ids) or spec.get("normalizer") or spec["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError("the vocabulary must list its tokens in the order of the merges, without normaliser or prefix")
        self.leaf_chars = leaf_chars
        self.core = tiktoken.Encoding("tree", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        size = max([*ranks.values(), *self.special.values()]) + 1
        self.table = [b""] * size
        for token, i in [*ranks.items(), *((t.encode(), i) for t, i in self.special.items())]:
            self.table[i] = token
        self.special_pattern = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.longest_special = max(map(len, self.special), default=0)

    # Leaves

    def plain(self, text: str) -> list[int]:
        """The ids of ``text`` in one go."""
        return self.core.encode(text, allowed_special="all")

    def decode(self, ids: list[int]) -> bytes:
        """The text of ``ids`` in UTF-8; bytes that are not UTF-8 become replacement characters."""
        table = self.table
        raw = b"".join([table[i] for i in ids])
        return raw.decode("utf-8", "replace").encode("utf-8")

    # Joins

    def _bytes(self, ids: list[int]) -> bytes:
        table = self.table
        return b"".join([table[i] for i in ids])

    def _fits(self, left: int, right: int) -> bool:
        """Whether BPE leaves this pair of tokens of one pre-token as it is."""
        return self.core._encode_single_piece(self.table[left] + self.table[right]) == [left, right]

    def _hard(self, text: str, at: int) -> bool:
        """Whether no pre-token and no special token can span the place before ``text[at]``."""
        before, after = text[at - 1], text[at]
        kind, next_kind = _kind(before), _kind(after)
        if kind in "LN":
            hard = next_kind != kind
        elif kind == "S":
            hard = before != " " and next_kind != "S"
        else:
            hard = next_kind != "P" and (before != "'" or next_kind != "L")
        if hard and self.special_pattern:
            around = max(0, at - self.longest_special)
            found = self.special_pattern.finditer(text[around : at + self.longest_special])
            hard = not any(around + m.start() < at < around + m.end() for m in found)
        return hard

    def _seam(self, text: str, inner: range) -> int | None:
        """The first hard boundary in ``inner``."""
        return next((i for i in inner if 0 < i < len(text) and self._hard(text, i)), None)

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The ids of the joined text, from those of its parts."""
        if not left or not right:
            return left or right
        size = FIRST_WINDOW
        while True:
            a, b = min(size, len(left)), min(size, len(right))
            while True:  # whole characters only
                head, tail = self._bytes(left[len(left) - a :]), self._bytes(right[:b])
                try:
                    text = (head + tail).decode("utf-8")
                    place = len(head.decode("utf-8"))
                    break
                except UnicodeDecodeError:
                    if a == len(left) and b == len(right):
                        return self.plain((head + tail).decode("utf-8", "replace"))
                    a, b = min(a + 1, len(left)), min(b + 1, len(right))
            ids = self.plain(text)
            begin, keep_left = self._agree_left(left, a, text, place, ids)
            end, keep_right = self._agree_right(right, b, text, place, ids)
            if begin is not None and end is not None and begin <= end:
                return left[:keep_left] + ids[begin:end] + right[keep_right:]
            size *= 2

    def _agree_left(self, left, a, text, place, ids):
        """The first token of the window to use, and the tokens of ``left`` to keep; (None, 0) without agreement."""
        if a == len(left):
            return 0, 0
        seam = self._seam(text, range(1, place + 1))
        if seam is not None:
            skipped = len(text[:seam].encode("utf-8"))
            begin, kept = self._count(ids, skipped), self._count(left[len(left) - a :], skipped)
            if begin is not None and kept is not None:
                return begin, len(left) - a + kept
            return None, 0
        last = self.table[left[len(left) - a - 1]]
        if _kind(text[0]) in "LN" and _one_kind(last, _kind(text[0])) and self._fits(left[len(left) - a - 1], ids[0]):
            return 0, len(left) - a
        return None, 0

    def _agree_right(self, right, b, text, place, ids):
        """One past the last token of the window to use, and the first token of ``right`` to keep."""
        if b == len(right):
            return len(ids), b
        seam = self._seam(text, range(place + 1, len(text)))
        if seam is not None:
            behind = len(text[seam:].encode("utf-8"))
            end, kept = self._count(ids[::-1], behind), self._count(right[:b][::-1], behind)
            if end is not None and kept is not None:
                return len(ids) - end, b - kept
            return None, 0
        following = self.table[right[b]]
        if _kind(text[-1]) in "LN" and _one_kind(following, _kind(text[-1])) and self._fits(ids[-1], right[b]):
            return len(ids), b
        return None, 0

    def _count(self, ids: list[int], size: int) -> int | None:
        """How many of ``ids`` make up the first ``size`` bytes; None if a token spans that place."""
        done = 0
        for n, i in enumerate(ids):
            if done >= size:
                return n if done == size else None
            done += len(self.table[i])
        return len(ids) if done == size else None

    def tree(self, parts: list[list[int]]) -> list[int]:
        """The ids of all parts together, joined pairwise."""
        while len(parts) > 1:
            pairs = [self.join(parts[i], parts[i + 1]) for i in range(0, len(parts) - 1, 2)]
            parts = pairs + parts[len(parts) - len(parts) % 2 :]
        return parts[0] if parts else []

    def encode(self, text: str) -> list[int]:
        """The ids of ``text`` by tree concatenation of its leaves."""
        size = self.leaf_chars
        if len(text) <= size:
            return self.plain(text)
        return self.tree([self.plain(text[i : i + size]) for i in range(0, len(text), size)])


@lru_cache(maxsize=1 << 16)
def _kind(char: str) -> str:
    """L for letters, N for numbers, S for white space, P for all others, as the pattern classes them."""
    category = unicodedata.category(char)[0]
    if category in "LN":
        return category
    white = "\t" <= char <= "\r" or char == "\x85" or category == "Z"
    return "S" if white else "P"


def _one_kind(token: bytes, kind: str) -> bool:
    """Whether a token holds whole characters of one kind; a token with parts of characters does not count."""
    try:
        return all(_kind(c) == kind for c in token.decode("utf-8"))
    except UnicodeDecodeError:
        return False


@lru_cache(maxsize=4)
def encoder(path: str, leaf_chars: int = LEAF_CHARS) -> TreeEncoder:
    return TreeEncoder(path, leaf_chars)


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


def _text(value: bytes | None) -> str:
    return (value or b"").decode("utf-8", "replace")


def encode_documents(
    docs: DataFrame, path: str, leaf_chars: int = LEAF_CHARS, segment_chars: int = SEGMENT_CHARS
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and ``ids`` (little-endian unsigned 32-bit integers).

    Segments of long texts meet again by document; of a repeated row they are joined once, and the result repeated.
    """

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = encoder(path, leaf_chars)
        for batch in batches:
            made = [_packed(tree.encode(_text(t.as_py()))) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["doc_id", "ids"])

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = encoder(path, leaf_chars)
        for batch in batches:
            made = [_packed(tree.encode(_text(t.as_py()))) for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(made, pa.binary())], ["doc_id", "text_hash", "pos", "ids"]
            )

    def joined(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        tree = encoder(path, leaf_chars)
        copies = int((group["pos"] == 0).sum())
        parts = group.drop_duplicates("pos").sort_values("pos")["ids"]
        ids = _packed(tree.tree([np.frombuffer(p, dtype="<u4").tolist() for p in parts]))
        return pd.DataFrame({"doc_id": group["doc_id"].iloc[:copies], "ids": [ids] * copies})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    long = F.char_length("text") > segment_chars
    whole = rows.filter(~long).select("doc_id", F.encode("text", "UTF-8")).mapInArrow(short, "doc_id long, ids binary")
    cut = rows.filter(long).select(
        "doc_id",
        F.md5("text").alias("text_hash"),
        F.posexplode(F.expr(rf"regexp_extract_all(text, '(?s).{{1,{segment_chars}}}', 0)")).alias("pos", "segment"),
    )
    dealt = cut.repartition("text_hash", "pos").select("doc_id", "text_hash", "pos", F.encode("segment", "UTF-8"))
    encoded = dealt.mapInArrow(segments, "doc_id long, text_hash string, pos int, ids binary")
    merged = encoded.groupBy("doc_id", "text_hash").applyInPandas(joined, "doc_id long, ids binary")
    return whole.unionByName(merged)


def digests(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of rows of :func:`encode_documents`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = encoder(path)
        for batch in batches:
            packed = [value.as_py() for value in batch.column(1)]
            decoded = [tree.decode(np.frombuffer(p, dtype="<u4").tolist()) for p in packed]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(p) // 4 for p in packed], pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
                    pa.array([hashlib.sha256(d).hexdigest() for d in decoded]),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return encoded.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``text`` of rows of :func:`encode_documents`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = encoder(path)
        for batch in batches:
            texts = [tree.decode(np.frombuffer(v.as_py(), dtype="<u4").tolist()).decode() for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def encoding_digests(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: ``doc_id``, ``n_tokens`` and the digests of its ids and of the text decoded from them."""
    return digests(encode_documents(docs, path), path)
