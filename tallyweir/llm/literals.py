"""Small fixed tables as SQL literals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_table(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A table of ``rows`` (strings or numbers), one partition, without Python or RDD code at run time."""
    structs = [F.struct(*(F.lit(v).alias(n) for v, n in zip(row, names))) for row in rows]
    if not structs:
        return spark.range(0).select(*(F.lit("").alias(n) for n in names))
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))
