"""Line dedup: lines found on many distinct sites are boilerplate, and are removed everywhere but in one document.

The sites of each line are counted with HyperLogLog sketches, which Spark merges task by task, so that a line
found in a third of all documents costs one sketch per task. A line whose estimate is clearly above or below
``min_sites`` is settled by it; only lines within ``BAND`` of the threshold get an exact distinct count, as the
estimate's error there could decide. The result therefore equals that of exact counting.

A line is compared in lower case, with white space runs as one blank and digits as ``0``; lines without a letter
or digit are never boilerplate. The document with the smallest id keeps its boilerplate lines, so that no text
vanishes from the corpus altogether.

Defined results: a null text has no lines and stays null; a null site counts as one site of its own; documents
with a null id come after all others when the keeper is chosen; repeated rows of one id and text count as one
document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweir.session import materialize

MIN_SITES = 5
SKETCH_BITS = 12
#: Far beyond the sketch's standard error of 1.04 / sqrt(2 ** SKETCH_BITS), that is 1.6 percent.
BAND = 0.2


def line_key(line: Column) -> Column:
    """The 64-bit hash under which a line is compared; null for a line without a letter or digit."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), r"\p{Nd}", "0"), r"\s+", " "))
    return F.when(plain.rlike(r"[\p{L}\p{Nd}]"), F.xxhash64(plain))


def line_table(docs: DataFrame) -> DataFrame:
    """``doc``, ``text_hash``, ``pos``, ``line`` (hash) and ``site`` (hash) of every comparable line."""
    lines = docs.filter("text is not null").select(
        F.col("doc_id").alias("doc"),
        F.xxhash64("text").alias("text_hash"),
        F.xxhash64(F.coalesce(F.col("source"), F.lit("\u0000"))).alias("site"),
        F.posexplode_outer(F.split("text", "\n")).alias("pos", "_line"),
    )
    return lines.select("doc", "text_hash", "pos", "site", line_key(F.col("_line")).alias("line")).filter(
        "line is not null"
    )


def boilerplate_lines(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``line`` and ``keeper`` (document id) of the lines on ``min_sites`` or more sites; ``lines`` should be stored.

    A line whose smallest and largest site hash agree is on one site, and needs no sketch.
    """
    seen = lines.groupBy("line").agg(
        F.count(F.lit(1)).alias("n"), F.min("site").alias("low"), F.max("site").alias("high"), F.min("doc").alias("keeper")
    )
    spread = materialize(
        seen.filter((F.col("n") >= min_sites) & ((F.col("low") != F.col("high")) | F.lit(min_sites <= 1))).select(
            "line", "keeper"
        ),
        "repeated-lines",
    )
    repeated = lines.select("line", "site").join(spread, "line", "left_semi")
    estimated = repeated.groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH_BITS))).alias("sites")
    )
    judged = materialize(estimated.filter(F.col("sites") >= min_sites * (1 - BAND)), "line-sketches")
    clear = judged.filter(F.col("sites") > min_sites * (1 + BAND)).select("line")
    near = judged.filter(F.col("sites") <= min_sites * (1 + BAND)).select("line")
    exact = (
        repeated.join(near, "line", "left_semi")
        .distinct()
        .groupBy("line")
        .agg(F.count(F.lit(1)).alias("sites"))
        .filter(F.col("sites") >= min_sites)
        .select("line")
    )
    return clear.unionByName(exact).join(spread, "line")


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with ``text`` freed of boilerplate, plus ``n_lines`` and ``n_removed`` (columns of those names are replaced)."""
    lines = materialize(line_table(docs.select("doc_id", "text", "source")), "lines")
    boilerplate = materialize(boilerplate_lines(lines, min_sites), "boilerplate")
    hits = lines.join(boilerplate, "line").filter("NOT (doc <=> keeper)")
    removed = hits.groupBy("doc", "text_hash").agg(F.array_sort(F.collect_set("pos")).alias("_removed"))
    names = [c for c in docs.columns if c not in {"text", "n_lines", "n_removed"}]
    packed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in names)).alias("_row"),
        F.col("doc_id").alias("_id"),
        F.col("text").alias("_text"),
        F.xxhash64("text").alias("_hash"),
    )
    joined = packed.join(removed, F.col("_id").eqNullSafe(F.col("doc")) & (F.col("_hash") == F.col("text_hash")), "left")
    cut = joined.select("_row", "_text", F.split("_text", "\n").alias("_lines"), "_removed")
    # the runs of lines between two removed ones, so that the work is proportional to the lines
    edges = cut.withColumn("_edges", F.expr("concat(array(-1), _removed, array(size(_lines)))"))
    runs = """array_join(flatten(transform(sequence(1, size(_edges) - 1),
        j -> slice(_lines, _edges[j - 1] + 2, _edges[j] - _edges[j - 1] - 1))), '\n')"""
    return edges.select(
        "_row.*",
        F.expr(f"if(_removed is null, _text, {runs})").alias("text"),
        F.expr("if(_text is null, 0, size(_lines))").cast("long").alias("n_lines"),
        F.expr("if(_removed is null, 0, size(_removed))").cast("long").alias("n_removed"),
    )
