"""File and table sources. Every schema is declared; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyweir.functions.text import is_blank
from tallyweir.schemas import BUSINESS_COLUMNS, DEAD_LETTER, DOCUMENT, LANDING, MESSAGE


def scan_csv_strings(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    order: list[Column] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """CSV with a header, every column as text, empty fields as ''.

    A ``limit`` needs an ``order``: files have no order of their own once they are split.
    """
    schema = StructType([StructField(c, StringType()) for c in columns or BUSINESS_COLUMNS])
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", False)
        .option("escape", '"')
        .csv(path)
        .na.fill("")
    )
    if limit is None:
        return rows
    if not order:
        raise ValueError("a limit needs an order")
    return rows.orderBy(*order).limit(limit)


def scan_landing(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Accepted records from JSON lines; empty files are fine as the schema is known."""
    return spark.read.schema(LANDING).json(paths)


def scan_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def scan_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, title, text) from JSON lines, blank lines skipped."""
    lines = spark.read.text(path).filter(~is_blank(F.col("value")))
    return lines.select(F.from_json("value", DOCUMENT).alias("d")).select("d.*")


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The dead letters written by the ingestion, first to last."""
    return spark.read.schema(DEAD_LETTER).json(path)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """A bounded read of a message folder written by ``write_messages``."""
    return spark.read.schema(MESSAGE).json(path)
