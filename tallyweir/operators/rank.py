"""Ranking that never puts all rows, or a whole hot group, into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweir.session import materialize

_POSITION_BITS = 33  # the row part of monotonically_increasing_id; the rest is the partition


def global_rank(
    df: DataFrame,
    order: list[Column],
    output: str = "rank",
    total: str | None = None,
    start: int = 1,
) -> DataFrame:
    """Dense row numbers over the whole table, and optionally the table's row count.

    ``order`` should be a total order; equal rows get their numbers in no particular order. Rows are
    range-partitioned and sorted, and each keeps its partition and its place there. The table is
    stored with these two numbers, so they can't change between the counting and the numbering
    pass. A place then becomes a rank by adding the row counts of the partitions before it: one row
    per partition. Only columns of ``order`` decide the ranges, so a value that fills a third of the
    table is still split by the tie-break columns after it.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()
    placed = (
        df.repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn("_id", place)
        .withColumn("_part", F.shiftright("_id", _POSITION_BITS))
        .withColumn("_place", F.col("_id").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)))
        .drop("_id")
    )
    stored = materialize(placed, "ranked")
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
        F.sum("_size").over(everything).alias("_total"),
    )
    joined = stored.join(F.broadcast(offsets), "_part")
    columns = [F.col(c) for c in df.columns]
    columns.append((F.col("_before") + F.col("_place") + start).alias(output))
    if total is not None:
        columns.append(F.col("_total").alias(total))
    return joined.select(*columns)


def top_n_per_group(df: DataFrame, group: list[str], order: list[Column], n: int, output: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group, numbered from 1.

    Spark applies the limit within each task before the shuffle, so a hot group sends at most ``n``
    rows per task.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(output, F.row_number().over(window)).filter(F.col(output) <= n)
