"""Source divergence audit: how far the term shares of the sources of a language lie apart, by in-mapper stripes.

1. Folding. A task folds whole documents into hash stripes, ``term -> source -> (documents, uses)`` per language, held as one
   counter of documents and one of uses per language and source. At ``SPILL_ENTRIES`` entries the stripes spill: they
   leave the task as rows, and folding starts anew. The empty term marks that a source occurs in a language.
2. Merging. Spilled entries meet by language and term and are added up. A term sends at most one row per source and
   spill, so the commonest term is no larger a group than any other that is in all tasks. Terms in fewer than ``MIN_DOCS``
   documents of their language go. What stays is stored as merged stripes.
3. Emitting. The sums per language and source need one small pass. The merged stripes of a language are cut into slices of
   about ``SLICE_ENTRIES`` entries, and each slice directly emits its part of all pair sums and its ten best terms per source.
   In a slice, terms that two sources both lack have the same value, so only entries that exist are computed:
   a pair's sum is that over the terms of the one, plus the other, less both, plus a constant for each other term.

All arithmetic is on 64-bit integers and exact: shares by long division in base 1000, and squares of less than 2^63.

Defined results: null texts, languages and sources are empty ones; repeated rows are documents of their own; very long texts
are folded in pieces that end between terms; a source without terms has pairs, with counts of zero, and no terms;
a language of one source has no pairs; further columns are ignored; an empty table has no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweir.session import broadcast_if_small, materialize

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
SPILL_ENTRIES = 300_000
SLICE_ENTRIES = 1 << 18
PIECE_BYTES = 1 << 20
_CELLS = 1 << 20

#: In UTF-8 every byte of a character beyond ASCII is at least 0x80; ``bytes.lower`` changes A-Z only.
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_BREAK = re.compile(rb"[^A-Za-z\x80-\xff]")
_ENTRY = "lang string, term string, source string, docs long, uses long"
_PART = "source string, part string, item string, value long"


def pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """``text`` in pieces of about ``size`` bytes that end between terms."""
    at = 0
    while at < len(text):
        cut = _BREAK.search(text, at + size)
        end = cut.start() if cut and at + size < len(text) else len(text)
        yield text[at:end]
        at = end


class Stripes:
    """The stripes of the documents folded since the last spill."""

    def __init__(self) -> None:
        self.docs: dict[tuple[str, str], Counter] = {}
        self.uses: dict[tuple[str, str], Counter] = {}
        self.entries = 0

    def fold(self, text: bytes, lang: str, source: str) -> None:
        docs = self.docs.setdefault((lang, source), Counter())
        uses = self.uses.setdefault((lang, source), Counter())
        before, seen = len(docs), {b""}
        for piece in pieces(text):
            terms = _TERM.findall(piece.lower())
            uses.update(terms)
            seen.update(terms)
        docs.update(seen)
        self.entries += len(docs) - before

    def spill(self, rows: int = 1 << 14) -> Iterator[pa.RecordBatch]:
        for (lang, source), docs in self.docs.items():
            uses, terms = self.uses[lang, source], list(docs)
            for low in range(0, len(terms), rows):
                part = terms[low : low + rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(part), pa.string()),
                        pa.array(part, pa.binary()).cast(pa.string()),
                        pa.array([source] * len(part), pa.string()),
                        pa.array([docs[t] for t in part], pa.int64()),
                        pa.array([uses[t] for t in part], pa.int64()),
                    ],
                    ["lang", "term", "source", "docs", "uses"],
                )
        self.__init__()


def folded(docs: DataFrame, spill_entries: int = SPILL_ENTRIES) -> DataFrame:
    """The spilled entries of all tasks: ``lang``, ``term``, ``source``, ``docs`` and ``uses``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripes = Stripes()
        for batch in batches:
            langs, sources = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for text, lang, source in zip(batch.column(0), langs, sources):
                stripes.fold(text.as_py(), lang, source)
                if stripes.entries >= spill_entries:
                    yield from stripes.spill()
        yield from stripes.spill()

    whole = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lang", "source"))
    return docs.select(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), *whole).mapInArrow(run, _ENTRY)


def merged_stripes(entries: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Merged stripes, stored: ``lang``, ``term`` and ``stripe`` (an array of source and uses), and the marks of term ''."""
    summed = (
        entries.repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("docs").alias("docs"), F.sum("uses").alias("uses"))
    )
    merged = summed.groupBy("lang", "term").agg(
        F.sum("docs").alias("_docs"), F.collect_list(F.struct("source", "uses")).alias("stripe")
    )
    return materialize(merged.filter((F.col("term") == "") | (F.col("_docs") >= min_docs)).drop("_docs"), "stripes")


def shares(counts: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """``1 + floor(SCALE * (counts + 2) / whole)``, in three digits of base 1000, so that nothing passes 2^63."""
    digits, left = np.divmod(counts + 2, whole)
    for _ in range(3):
        digit, left = np.divmod(left * 1000, whole)
        digits = digits * 1000 + digit
    return digits + 1


def distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def pair_sums(counts: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """The sum of distances of every pair of sources (columns) over all terms (rows)."""
    n, width = counts.shape
    none = shares(np.zeros(width, dtype=np.int64), whole)
    one = np.zeros((width, width), dtype=np.int64)  # over the terms of the row's source
    both = np.zeros((width, width), dtype=np.int64)
    common = np.zeros((width, width), dtype=np.int64)
    step = max(1, _CELLS // max(1, width))
    for low in range(0, n, step):
        block = counts[low : low + step]
        p, has = shares(block, whole), block > 0
        for a in range(width):
            rows = np.flatnonzero(has[:, a])
            far = distances(p[rows], p[rows, a][:, None])
            one[a] += far.sum(axis=0)
            both[a] += np.where(has[rows], far, 0).sum(axis=0)
            common[a] += has[rows].sum(axis=0)
    own = np.diag(common)
    neither = n - own[:, None] - own[None, :] + common
    return one + one.T - both + neither * distances(none[:, None], none[None, :])


def _dense(stripes: pa.ListArray, places: dict[str, int]) -> np.ndarray:
    counts = np.zeros((len(stripes), len(places)), dtype=np.int64)
    sizes = np.diff(np.asarray(stripes.offsets))
    entries = stripes.flatten()
    columns = np.array([places[s] for s in entries.field("source").to_pylist()], dtype=np.int64)
    counts[np.repeat(np.arange(len(stripes)), sizes), columns] = np.asarray(entries.field("uses"))
    return counts


def emitted(stripes: pa.Table, groups: pa.Table, top: int = TOP_TERMS) -> pa.Table:
    """What one slice of a language's stripes adds to all pair sums, and its best terms per source."""
    groups = groups.sort_by("source")
    sources = groups.column("source").to_pylist()
    kept = groups.column("kept").to_numpy()
    total = groups.column("total").to_numpy()
    whole = np.maximum(total + 2 * kept, 1)
    places = {s: i for i, s in enumerate(sources)}
    column = stripes.column("stripe").combine_chunks()
    counts = _dense(column, places) if len(stripes) else np.zeros((0, len(sources)), dtype=np.int64)
    a, b = np.nonzero(~np.eye(len(sources), dtype=bool))
    out = [[sources[i] for i in a], ["pair"] * len(a), [sources[i] for i in b], pair_sums(counts, whole)[a, b].tolist()]
    if len(stripes):
        q = shares(counts.sum(axis=1), np.int64(max(1, total.sum() + 2 * kept[0])))
        terms = np.array([t.encode() for t in stripes.column("term").to_pylist()], dtype=object)
        for i, source in enumerate(sources):
            p = shares(counts[:, i], whole[i])
            rows = np.flatnonzero((counts[:, i] > 0) & (p > q))
            far = distances(p[rows], q[rows])
            best = sorted(zip((-far).tolist(), terms[rows]))[:top]
            for side, values in zip(out, ([source] * len(best), ["term"] * len(best), [t.decode() for _, t in best], [-f for f, _ in best])):
                side.extend(values)
    names = ["source", "part", "item"]
    return pa.table({**{k: pa.array(v, pa.string()) for k, v in zip(names, out)}, "value": pa.array(out[3], pa.int64())})


def _slices(stripes: DataFrame, slice_entries: int) -> tuple[DataFrame, DataFrame]:
    """The kept stripes with ``lang`` and ``slice``, and for each slice all sources of its language with their sums."""
    terms = stripes.filter("term <> ''")
    sums = terms.select("lang", F.explode("stripe").alias("e")).groupBy("lang", F.col("e.source").alias("source"))
    sums = sums.agg(F.sum("e.uses").alias("total"))
    sizes = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum(F.size("stripe")).alias("entries"))
    occurring = stripes.filter("term = ''").select("lang", F.explode("stripe.source").alias("source"))
    groups = occurring.join(sums, ["lang", "source"], "left").join(broadcast_if_small(materialize(sizes, "languages")), "lang", "left")
    count = F.coalesce(F.ceil(F.col("entries") / slice_entries), F.lit(1)).cast("int")
    zero = F.lit(0).cast("long")
    groups = groups.select(
        "lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("kept", zero).alias("kept"),
        F.explode(F.sequence(F.lit(0), count - 1)).alias("slice"),
    )
    counts = broadcast_if_small(materialize(sizes.select("lang", count.alias("_n")), "slices"))
    placed = terms.join(counts, "lang").withColumn("slice", F.pmod(F.xxhash64("term"), F.col("_n")).cast("int"))
    return placed.select("lang", "slice", "term", "stripe"), materialize(groups, "slice-sources")


def source_divergence(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    spill_entries: int = SPILL_ENTRIES,
    slice_entries: int = SLICE_ENTRIES,
) -> DataFrame:
    """``lang``, ``source``, ``part`` ('pair' or 'term'), ``item``, ``value`` and ``rank``."""
    stripes = merged_stripes(folded(docs, spill_entries), min_docs)
    placed, groups = _slices(stripes, slice_entries)

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        made = emitted(left, right)
        return made.add_column(0, "lang", pa.array([key[0].as_py()] * len(made), pa.string()))

    parts = placed.groupBy("lang", "slice").cogroup(groups.groupBy("lang", "slice")).applyInArrow(run, f"lang string, {_PART}")
    parts = materialize(parts, "divergences")
    pairs = parts.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    rank = F.row_number().over(order)
    terms = parts.filter("part = 'term'").withColumn("rank", rank).filter(F.col("rank") <= TOP_TERMS)
    both = pairs.withColumn("rank", rank).unionByName(terms)
    return both.select("lang", "source", "part", "item", "value", "rank")


ORACLE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
uses AS (SELECT d, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term FROM uses GROUP BY ALL HAVING count(DISTINCT d) >= 10),
sources AS (SELECT DISTINCT lang, source FROM docs),
counts AS (
  SELECT k.lang, s.source, k.term, count(u.d) AS n
  FROM kept k JOIN sources s ON k.lang = s.lang
  LEFT JOIN uses u ON u.lang = k.lang AND u.source = s.source AND u.term = k.term GROUP BY ALL),
shares AS (
  SELECT lang, source, term, n,
         CAST(1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER g + 2 * count(*) OVER g) AS HUGEINT) AS p
  FROM counts WINDOW g AS (PARTITION BY lang, source)),
whole AS (
  SELECT lang, term, CAST(1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER g + 2 * count(*) OVER g) AS HUGEINT) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM counts GROUP BY ALL) WINDOW g AS (PARTITION BY lang)),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         coalesce((SELECT sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) FROM shares x JOIN shares y
                   ON x.lang = y.lang AND x.term = y.term
                   WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source),
terms AS (
  SELECT s.lang, s.source, 'term' AS part, s.term AS item, ((p - q) * (p - q)) // (p + q) AS value
  FROM shares s JOIN whole w ON s.lang = w.lang AND s.term = w.term WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""
