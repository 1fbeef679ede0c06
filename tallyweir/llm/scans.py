"""Orders and running totals over whole tables, whose groups may be larger than a task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweir.session import materialize

_PLACE_BITS = 33  # the row part of monotonically_increasing_id; the rest is the partition


def ordered(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """``df`` in ``order`` over the whole table, stored, with ``row`` (increasing) and ``part`` (its range).

    Only columns of ``order`` decide the ranges, so a group that fills a third of the table is cut by the columns
    behind its key. Per group and range, a table has one summary row; what holds for a group is joined by both.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    placed = placed.withColumn("row", F.monotonically_increasing_id())
    return materialize(placed.withColumn("part", F.shiftright("row", _PLACE_BITS)), label)


_COMBINED = {"sum": lambda a, b: a + b, "bit_xor": lambda a, b: a.bitwiseXOR(b)}


def running(df: DataFrame, keys: list[str], index: str, values: dict[str, str], block: int = 1 << 12) -> DataFrame:
    """``df`` plus ``<value>_before``: sum or bit_xor of ``value`` over the rows of equal ``keys`` and smaller ``index``.

    ``index`` counts from 0 and is unique per key, neither it nor keys are null. Rows are added up in blocks of the
    index, then the blocks' totals in the same way, so no task holds more than ``block`` rows of a key.
    """
    blocked = df.withColumn("_block", F.expr(f"`{index}` div {block}"))
    window = Window.partitionBy(*keys, "_block").orderBy(index).rowsBetween(Window.unboundedPreceding, -1)
    before = {v: F.coalesce(F.expr(f"{kind}(`{v}`)").over(window), F.lit(0).cast("long")) for v, kind in values.items()}
    inner = blocked.select("*", *(column.alias(f"{v}_before") for v, column in before.items()))
    totals = materialize(
        blocked.groupBy(*keys, "_block").agg(*(F.expr(f"{kind}(`{v}`)").alias(v) for v, kind in values.items())), "blocks"
    )
    if totals.filter("_block > 0").isEmpty():
        return inner.drop("_block")
    carried = running(totals.withColumnRenamed("_block", "_at"), keys, "_at", values, block)
    carried = carried.select(*keys, F.col("_at").alias("_block"), *(F.col(f"{v}_before").alias(f"_{v}") for v in values))
    joined = inner.join(carried, [*keys, "_block"])
    return joined.select(
        *(F.col(f"`{c}`") for c in df.columns),
        *(_COMBINED[kind](F.col(f"{v}_before"), F.col(f"_{v}")).alias(f"{v}_before") for v, kind in values.items()),
    )
