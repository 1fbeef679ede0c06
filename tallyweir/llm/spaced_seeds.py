"""Benchmark decontamination with spaced seeds.

A seed is a fixed mask over consecutive tokens that ignores some positions, so a replaced word under an ignored
position does not hide a shared passage. The masked token windows of all documents are hash-joined with those of
the benchmark. Around each hit, document and item are compared token by token on the hit's diagonal; a document
is contaminated if some window of ``WINDOW`` tokens agrees in all but ``MAX_SUBSTITUTIONS`` of them. An item with
fewer tokens must agree as a whole, with proportionally fewer substitutions.

Tokens are runs of letters and digits in lower case. The masked windows of a document are joined where they are made:
the benchmark's windows are broadcast in blocks of at most ``BLOCK_ROWS`` rows, one pass over the documents for
each block, so that no window of a document is ever shuffled, and a passage that a third of all documents share
stays spread as the documents are. Hits become one row per document, item, diagonal and task before they move.

No passage is missed: wherever up to two of thirteen tokens are replaced, one of the two masks fits in between, and
the same holds for one of eleven or twelve. Shorter items have masks of their own: half an item of seven to ten tokens,
of which one may be replaced, and the whole of a shorter one, of which none may (``tests/llm`` tries all lengths and
placements). The documents are hashed only under the masks that some item has.

Defined results: null and empty texts have no tokens and match nothing; an empty benchmark contaminates nothing;
repeated rows are judged alike.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweir.session import broadcast_if_small, materialize

#: Positions that count, within windows of consecutive tokens; "0" positions are ignored.
MASKS = ["10101111", "111001101"]
#: Items with fewer tokens have masks of their own.
LONG = 11
WINDOW = 13
MAX_SUBSTITUTIONS = 2
BLOCK_ROWS = 1_000_000
#: Items with fewer tokens ("Paris", "Yes.") are common words; they are reported, but no document goes for them.
LEAST_REMOVED = 8

_TOKENS = r"array_remove(split(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), '')"


def masks_of(size: int) -> list[str]:
    """The masks for items of ``size`` tokens: wherever the allowed substitutions are, one of their windows is whole."""
    if size >= LONG:
        return MASKS
    return ["1" * (size // 2 if size * MAX_SUBSTITUTIONS >= WINDOW else size)]


def _hashes(tokens: str, mask: str) -> str:
    """The hashes of all windows of ``tokens`` under ``mask``, by their first position."""
    picked = ", ".join(f"{tokens}[i + {k}]" for k, bit in enumerate(mask) if bit == "1")
    return f"""if(size({tokens}) < {len(mask)}, cast(array() as array<bigint>), transform(
        sequence(0, size({tokens}) - {len(mask)}), i -> xxhash64({MASKS.index(mask) if mask in MASKS else -len(mask)}, {picked})))"""


def _windows(texts: DataFrame, keys: list[str], masks: list[str]) -> DataFrame:
    """``keys``, ``at`` and ``hash`` of every masked window of ``texts`` (``keys`` and ``words``)."""
    made = texts.select(*keys, *(F.expr(_hashes("words", m)).alias(f"_h{i}") for i, m in enumerate(masks)))
    ends = [" + ".join(f"size(_h{k})" for k in range(i + 1)) for i in range(len(masks))]
    joined = made.selectExpr(
        *keys, f"concat({', '.join(f'_h{i}' for i in range(len(masks)))}) as _all", *(f"{e} as _e{i}" for i, e in enumerate(ends))
    )
    # the outer form keeps Spark from making the array a second time, in a filter on its size below
    placed = joined.select(*keys, *(f"_e{i}" for i in range(len(masks))), F.posexplode_outer("_all").alias("_i", "hash"))
    at = "case " + " ".join(f"when _i < _e{i} then _i - {f'_e{i - 1}' if i else 0}" for i in range(len(masks))) + " end"
    return placed.select(*keys, F.expr(at).alias("at"), "hash").filter("hash is not null")


def _tokens(texts: DataFrame, *keys: str) -> DataFrame:
    return texts.select(*keys, F.xxhash64("text").alias("text_hash"), F.expr(_TOKENS.format(text="text")).alias("words"))


def _blocks(seeds: DataFrame, block_rows: int) -> list[DataFrame]:
    """``seeds`` (stored) in as many parts as keep each to about ``block_rows`` rows of four integers."""
    parts = -(-seeds.count() // block_rows)
    if parts <= 1:
        return [seeds] * parts
    return [seeds.filter(F.pmod(F.xxhash64("item_hash", "q"), F.lit(parts)) == i) for i in range(parts)]


def _best_window() -> str:
    """Most equal tokens in any window of ``WINDOW`` tokens of ``item`` around the hits, on their diagonal ``d``."""
    reach = max(map(len, MASKS)) + WINDOW
    # positions beyond either text do not agree
    equal = f"""transform(sequence(greatest(0, q_low - {WINDOW}), least(size(item), q_high + {reach}) - 1),
        k -> if(d + k >= 0 AND get(words, d + k) <=> item[k], 1, 0))"""
    slid = f"s.now + x - if(size(s.seen) < {WINDOW}, 0, s.seen[0])"
    return f"""aggregate({equal}, named_struct('best', 0, 'now', 0, 'seen', cast(array() as array<int>)), (s, x) ->
        named_struct('best', greatest(s.best, {slid}), 'now', {slid},
                     'seen', concat(if(size(s.seen) < {WINDOW}, s.seen, slice(s.seen, 2, {WINDOW})), array(x))),
        s -> s.best)"""


def overlaps(docs: DataFrame, items: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per contaminated document and item: ``doc_id``, ``text_hash``, ``item_id``, ``matched``, ``compared``.

    ``matched`` of ``compared`` tokens agree in the best window.
    """
    benchmark = materialize(_tokens(items, "item_id").filter("size(words) > 0"), "benchmark")
    texts = benchmark.select(F.col("text_hash").alias("item_hash"), "words").dropDuplicates(["item_hash"])
    sizes = sorted(r[0] for r in texts.select(F.least(F.size("words"), F.lit(LONG))).distinct().collect())  # LONG at most
    words = _tokens(docs, "doc_id")
    found = []
    if sizes:
        sized = [_windows(texts.filter(F.least(F.size("words"), F.lit(LONG)) == n), ["item_hash"], masks_of(n)) for n in sizes]
        seeds = materialize(reduce(DataFrame.unionByName, sized).withColumnRenamed("at", "q").distinct(), "seeds")
        masks = list(dict.fromkeys(mask for n in sizes for mask in masks_of(n)))
        windows = _windows(words, ["doc_id", "text_hash"], masks)
        found = [windows.join(F.broadcast(block), "hash") for block in _blocks(seeds, block_rows)]
    if not found:
        none = F.lit(None).cast(benchmark.schema["item_id"].dataType).alias("item_id")
        hashed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), none)
        return hashed.withColumns({"matched": F.lit(0), "compared": F.lit(0)}).filter("false")
    hits = reduce(DataFrame.unionByName, found).groupBy(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "item_hash", (F.col("at") - F.col("q")).alias("d")
    )
    diagonals = materialize(hits.agg(F.min("q").alias("q_low"), F.max("q").alias("q_high")), "diagonals")
    named = benchmark.select("item_id", F.col("text_hash").alias("item_hash"), F.col("words").alias("item"))
    # the hits go to the documents if there are few; else both are shuffled by document
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    placed = words.join(broadcast_if_small(diagonals), on).join(broadcast_if_small(named.distinct()), "item_hash")
    judged = placed.select(
        "doc_id",
        "text_hash",
        "item_id",
        F.expr(_best_window()).alias("matched"),
        F.expr(f"least({WINDOW}, size(item))").alias("compared"),
    )
    least = f"compared - compared * {MAX_SUBSTITUTIONS} div {WINDOW}"
    return (
        judged.groupBy("doc_id", "text_hash", "item_id")
        .agg(F.max("matched").alias("matched"), F.max("compared").alias("compared"))
        .filter(f"matched >= {least}")
    )


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per contaminated document and item: ``doc_id``, ``item_id``, ``matched``, ``compared``."""
    found = overlaps(docs, items)
    return found.groupBy("doc_id", "item_id").agg(
        F.max("matched").alias("matched"), F.max("compared").alias("compared")
    )


def remove_contaminated(docs: DataFrame, items: DataFrame, least_tokens: int = LEAST_REMOVED) -> DataFrame:
    """``docs`` without those that share a passage with a benchmark item of ``least_tokens`` or more, with their own columns."""
    found = overlaps(docs.select("doc_id", "text"), items).filter(F.col("compared") >= least_tokens).select(
        F.col("doc_id").alias("_b"), F.col("text_hash").alias("_c")
    )
    packed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"),
        F.col("doc_id").alias("_id"),
        F.xxhash64("text").alias("_hash"),
    )
    on = F.col("_id").eqNullSafe(F.col("_b")) & (F.col("_hash") == F.col("_c"))
    return packed.join(found.distinct(), on, "left_anti").select("_row.*")
