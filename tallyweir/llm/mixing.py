"""Mixing sources to target weights: blocks of words, multinomial draws per output shard, permuted block numbers.

1. Targets. Sources in code point order (null last) carry ``WEIGHTS`` in turn and share all words by them. A target stops
   at ``MAX_USES`` times its source's words; what is left is shared again until no target is above.
2. Packing. The words of a source, documents in order of id and text hash, form one stream, cut into blocks of
   ``BLOCK_WORDS``. A document's place is the sum of the sizes before it: sums per range of the sorted table, then
   places within a range, so a source of any size is shared by many tasks.
3. Drawing. The mix has a quota of slots per source, the rounded number of blocks that its target takes. Every shard of
   ``SHARD_SLOTS`` slots draws its source counts from the multinomial distribution of the quotas. Drawn totals
   scatter about the quotas, so some slots of sources drawn too often, evenly spaced, are dealt to those drawn too
   rarely, one by one through their running numbers. After that, totals equal the quotas.
4. Mapping. Slot ``j`` of a source with ``n`` blocks takes block ``permutation(j mod n)``, with a permutation of its own for
   every pass ``j div n``: a swap-or-not shuffle, which works for any ``n``. Quotas are at most ``MAX_USES * n``, so no block
   is taken more often than that.
5. Slots and the blocks' documents are joined by source and block number.

Everything is a column expression over hashes of ``SEED`` and of counters, so reruns agree. Sources are joined through
their ranges or slots, never all rows of one source by one key.

Defined results: a null, empty or blank text has size 0 and takes no part; a source without words has target 0; null ids
are ids like any other, behind the others; repeated rows are documents of their own; the last block of a source may be
short; very long texts span many blocks, and no row but the text itself grows with them; further columns are ignored; an
empty table has an empty mix.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweir.llm.scans import ordered, running
from tallyweir.operators.rank import global_rank
from tallyweir.session import broadcast_if_small, materialize

WEIGHTS = (5, 2, 1)
MAX_USES = 3
BLOCK_WORDS = 32
SHARD_SLOTS = 1024
SEED = 13
ROUNDS = 20

_WORD = r"[^\\x20\\x09-\\x0D]+"
_WORDS = f"regexp_extract_all(text, '{_WORD}', 0)"
_BIG = "decimal(38,0)"


class Mix(NamedTuple):
    """``sources``; ``placed`` documents (``row``, ``no`` of the source, ``start``, ``size``); ``slots`` (``slot``, ``no``, ``block``)."""

    sources: DataFrame
    placed: DataFrame
    slots: DataFrame
    block_words: int
    shard_slots: int


def with_targets(sources: DataFrame, max_uses: int = MAX_USES) -> DataFrame:
    """``sources`` (``source_size``, ``weight``) plus ``target``, by filling up: each pass closes all that reach their end.

    The passes read a table of one row per source and return three numbers; comparisons are exact.
    """
    size, weight = F.col("source_size").cast(_BIG), F.col("weight").cast(_BIG)
    end = size * max_uses
    rest, open_weight, closed, n_closed = 0, 0, F.lit(False), -1
    while True:
        row = sources.agg(
            (F.sum(size) - F.sum(F.when(closed, end).otherwise(0))).alias("rest"),
            F.sum(F.when(closed, 0).otherwise(weight)).alias("open"),
            F.count(F.when(closed, 1)).alias("n"),
        ).first()
        if row["n"] == n_closed or not row["open"]:
            break
        rest, open_weight, n_closed = int(row["rest"]), int(row["open"]), row["n"]
        closed = end * F.lit(open_weight).cast(_BIG) <= weight * F.lit(rest).cast(_BIG)
    shared = F.col("weight") * F.lit(float(rest)) / F.lit(float(max(open_weight, 1)))
    return sources.withColumn("target", F.when(closed, end.cast("double")).otherwise(shared))


def permuted(number: Column, n: Column, key: Column, rounds: int = ROUNDS) -> Column:
    """A pseudorandom permutation of 0 to ``n - 1``, chosen by ``key``, as a swap-or-not shuffle.

    Each round pairs ``x`` with ``k - x`` modulo ``n`` and swaps a pair or not by a hash of its larger member.
    """

    def swapped(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(key, r), n) - x, n)
        swaps = F.xxhash64(r, key, F.greatest(x, other)).bitwiseAND(F.lit(1)) == 1
        return F.when(swaps, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), number, swapped)


def _sources(sized: DataFrame, block_words: int) -> DataFrame:
    """One row per source: number, size, weight, target, blocks, and the quota of slots with its place among all."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = global_rank(totals, [F.col("source").asc_nulls_last()], "no", start=0)
    weights = F.array(*(F.lit(w) for w in WEIGHTS))
    weighted = ranked.withColumn("weight", F.get(weights, F.pmod("no", F.lit(len(WEIGHTS))).cast("int")))
    aimed = with_targets(materialize(weighted, "sources"))
    blocks = F.ceil(F.col("source_size") / block_words).cast("long")
    share = F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(0)
    quota = F.least(F.round(share).cast("long"), F.col("blocks") * MAX_USES)
    return materialize(running(aimed.withColumn("blocks", blocks).withColumn("quota", quota), [], "no", {"quota": "sum"}), "quotas")


def _placed(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """``sized`` plus ``row``, ``no``, ``source_size``, ``target`` and ``start``, the words of the source before it."""
    order = [F.col("source").asc_nulls_last(), F.col("doc_id").asc_nulls_last(), F.col("text_hash").asc_nulls_last()]
    rows = ordered(sized, order, "sized")
    ranges = rows.groupBy(F.col("source").alias("_source"), F.col("part").alias("_part")).agg(F.sum("size").alias("words"))
    known = sources.select(F.col("source").alias("_s"), "no", "source_size", "target")
    ranges = ranges.join(known, F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
    ranges = materialize(running(ranges, ["no"], "_part", {"words": "sum"}), "ranges")
    joined = rows.join(
        broadcast_if_small(ranges), F.col("source").eqNullSafe(F.col("_source")) & (F.col("part") == F.col("_part"))
    )
    inside = Window.partitionBy("part", "no").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("words_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    return joined.select("row", "doc_id", "text_hash", "no", "size", "source_size", "target", start.alias("start"))


def _drawn(sources: DataFrame, total: int, shard_slots: int, seed: int) -> DataFrame:
    """One row per shard and source drawn there: ``shard``, ``no``, ``n`` and the ``slots``.

    A slot's number among all quotas is a hash; the source whose quota holds it is found through cells of equal width.
    """
    spark = sources.sparkSession
    cell = -(-total // (1024 + sources.count()))
    quotas = sources.filter("quota > 0").selectExpr("no", "quota_before as low", "quota_before + quota as high")
    cells = quotas.withColumn("cell", F.explode(F.expr(f"sequence(low div {cell}, (high - 1) div {cell})")))
    tasks = max(spark.sparkContext.defaultParallelism, total >> 21)
    slots = spark.range(0, total, 1, tasks).withColumnRenamed("id", "slot")
    slots = slots.withColumn("u", F.pmod(F.xxhash64(F.lit(seed), "slot"), F.lit(total)))
    slots = slots.withColumn("cell", F.expr(f"u div {cell}"))
    found = slots.join(broadcast_if_small(materialize(cells, "cells")), "cell").filter("u >= low AND u < high")
    tally = found.groupBy(F.expr(f"slot div {shard_slots}").alias("shard"), "no")
    return tally.agg(F.sort_array(F.collect_list("slot")).alias("slots"), F.count(F.lit(1)).alias("n"))


def _totals(sources: DataFrame, drawn: DataFrame) -> DataFrame:
    """Per source, how many slots were drawn (``n``), how many ``over`` or ``under`` its quota, and their running sums."""
    counts = drawn.groupBy(F.col("no").alias("_no")).agg(F.sum("n").alias("n"))
    totals = sources.join(counts, F.col("no") == F.col("_no"), "left").withColumn("n", F.coalesce("n", F.lit(0)))
    totals = totals.select("no", "blocks", "n", F.expr("greatest(n - quota, 0)").alias("over"), F.expr("greatest(quota - n, 0)").alias("under"))
    return materialize(running(materialize(totals, "drawn"), [], "no", {"over": "sum", "under": "sum"}), "drawn-totals")


def _slots(sources: DataFrame, total: int, shard_slots: int, seed: int) -> DataFrame:
    """``slot``, ``no`` and ``block`` of the whole mix.

    Of ``n`` slots drawn, ``over`` are dealt to other sources, evenly spaced among the shards.
    """
    drawn = materialize(_drawn(sources, total, shard_slots, seed), "draws")
    totals = _totals(sources, drawn)
    known = totals.select("no", "blocks", F.col("n").alias("all"), "over", "over_before")
    numbered = running(drawn, ["no"], "shard", {"n": "sum"}).join(broadcast_if_small(known), "no")
    numbered = numbered.select("no", "blocks", "all", "over", "over_before", "n_before", F.posexplode("slots").alias("_p", "slot"))
    given = f"(cast(n_before + _p{{}} as {_BIG}) * over) div all"
    numbered = numbered.select(
        "slot", "no", "blocks", "over_before", (F.col("n_before") + F.col("_p")).alias("j"),
        F.expr(given.format("")).alias("given"), F.expr(given.format(" + 1")).alias("given_next"),
    )
    numbered = materialize(numbered, "numbered")
    kept = numbered.filter("given = given_next").selectExpr("slot", "no", "j - given as j", "blocks")
    units = totals.filter("under > 0").withColumn("i", F.explode(F.expr("sequence(0L, under - 1)")))
    units = units.selectExpr("under_before + i as unit", "no", "n + i as j", "blocks")
    moved = numbered.filter("given < given_next").selectExpr("slot", "over_before + given as unit")
    final = kept.unionByName(moved.join(units, "unit").select("slot", "no", "j", "blocks"))
    key = F.xxhash64(F.lit(seed), F.col("no"), F.expr("j div blocks"))
    keyed = final.withColumn("key", key)
    return keyed.select("slot", "no", permuted(F.expr("j % blocks"), F.col("blocks"), F.col("key")).alias("block"))


def plan_mix(
    docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED
) -> Mix:
    """The mix of ``docs`` as stored tables."""
    size = F.coalesce(F.expr(f"regexp_count(text, '{_WORD}')"), F.lit(0)).cast("long")
    sized = materialize(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", size.alias("size"), F.xxhash64("text").alias("text_hash")),
        "sizes",
    )
    sources = _sources(sized, block_words)
    total = sources.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    placed = materialize(_placed(sized, sources), "placed")
    if total:
        slots = materialize(_slots(sources, total, shard_slots, seed), "slots")
    else:
        slots = docs.sparkSession.range(0).selectExpr("id as slot", "id as no", "id as block")
    return Mix(sources, placed, slots, block_words, shard_slots)


def mixed_spans(mix: Mix) -> DataFrame:
    """What every slot holds: ``shard``, ``slot``, ``row``, ``doc_id``, ``text_hash``, ``first_word`` (from 0) and ``n_words``."""
    b = mix.block_words
    spread = mix.placed.filter("size > 0").withColumn(
        "block", F.explode(F.expr(f"sequence(start div {b}, (start + size - 1) div {b})"))
    )
    first = F.greatest(F.col("block") * b - F.col("start"), F.lit(0))
    last = F.least((F.col("block") + 1) * b - F.col("start"), F.col("size"))
    pieces = spread.select("no", "block", "row", "doc_id", "text_hash", first.alias("first_word"), (last - first).alias("n_words"))
    return pieces.join(mix.slots, ["no", "block"]).select(
        F.expr(f"slot div {mix.shard_slots}").alias("shard"), "slot", "row", "doc_id", "text_hash", "first_word", "n_words"
    )


def mixed_texts(docs: DataFrame, mix: Mix) -> DataFrame:
    """The mixed corpus: ``shard``, ``slot`` and ``words``, the block's text with single blanks.

    Texts are cut once per row into their blocks' pieces; a slot puts together at most one piece per word.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_hash"), "text")
    texts = texts.filter("text <> ''").dropDuplicates(["_id", "_hash"])
    rows = mix.placed.filter("size > 0").join(
        texts, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    )
    b = mix.block_words
    first, last = f"greatest(k * {b} - start, 0)", f"least((k + 1) * {b} - start, size)"
    piece = f"array_join(slice(_w, cast({first} + 1 as int), cast({last} - {first} as int)), ' ')"
    blocks = f"transform(sequence(start div {b}, (start + size - 1) div {b}), k -> struct(k as block, {piece} as piece))"
    cut = rows.withColumn("_w", F.expr(_WORDS)).select("no", "row", F.explode(F.expr(blocks)).alias("p"))
    pieces = cut.select("no", "row", F.col("p.block").alias("block"), F.col("p.piece").alias("piece"))
    held = pieces.join(mix.slots, ["no", "block"]).groupBy("slot").agg(
        F.sort_array(F.collect_list(F.struct("row", "piece"))).alias("w")
    )
    words = F.array_join(F.transform("w", lambda w: w["piece"]), " ")
    return held.select(F.expr(f"slot div {mix.shard_slots}").alias("shard"), "slot", words.alias("words"))


def mix_report(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``size``, ``source_size``, ``target`` and ``taken``, the words that the mix takes of it."""
    mix = plan_mix(docs)
    taken = mixed_spans(mix).groupBy(F.col("row").alias("_row")).agg(F.sum("n_words").alias("taken"))
    joined = mix.placed.join(taken, F.col("row") == F.col("_row"), "left")
    return joined.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))
