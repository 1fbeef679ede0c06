"""Product rows to text documents, documents to overlapping sentence chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweir.functions.text import is_blank, split_sentences, strip


def product_documents(gold: DataFrame, max_products: int | None = None) -> DataFrame:
    """(doc_id, title, text) of every product, or of the ``max_products`` best-ranked ones if that is given.

    The rank is a stored column, so a cut is a filter that reaches the scan.
    """
    rank = F.col("revenue_rank")
    name = F.coalesce(F.nullif("Description", F.lit("")), F.col("StockCode"))

    def number(column: str):
        return F.coalesce(F.col(column), F.lit(0)).cast("bigint").cast("string")

    # The sentence texts.
    sentences = [
        F.concat(
            name,
            F.lit(" (product code "),
            F.col("StockCode"),
            F.lit(") is a product sold through the online retail catalog."),
        ),
        F.format_string(
            "It generated total revenue of %.2f over the observed period.",
            F.coalesce(F.col("total_revenue"), F.lit(0.0)).cast("double"),
        ),
        F.concat(F.lit("A total of "), number("total_quantity"), F.lit(" units of this product were sold.")),
        F.concat(F.lit("It appeared across "), number("num_invoices"), F.lit(" separate invoices.")),
        F.concat(
            F.lit("Its top countries by sales were "),
            F.coalesce(F.col("top_countries"), F.lit("None")),
            F.lit("."),
        ),
        F.concat(
            F.lit("It ranks "),
            rank.cast("string"),
            F.lit(" out of "),
            F.col("total_products").cast("string"),
            F.lit(" products by total revenue."),
        ),
        F.when(
            rank == 1,
            "It is the top product by revenue: the number one best-selling, "
            "highest-revenue product in the entire catalog.",
        ).when(
            rank <= 10,
            F.concat(
                F.lit("It is one of the top 10 best-selling products by revenue (number "),
                rank.cast("string"),
                F.lit(")."),
            ),
        ),
    ]
    chosen = gold if max_products is None else gold.filter(rank <= max_products)
    return chosen.select(
        F.col("StockCode").alias("doc_id"), strip(name).alias("title"), F.concat_ws(" ", *sentences).alias("text")
    )


def chunk_id(doc_id: Column, pos: Column) -> Column:
    """The document id, "_chunk_" and the place with at least three digits."""
    digits = pos.cast("string")
    return F.concat(doc_id, F.lit("_chunk_"), F.when(pos < 1000, F.lpad(digits, 3, "0")).otherwise(digits))


def chunk_sentences(docs: DataFrame, chunk_size: int = 2) -> DataFrame:
    """(chunk_id, doc_id, pos, text): windows of ``chunk_size`` sentences, each starting
    ``chunk_size - 1`` (at least 1) sentences after the one before.

    ``pos`` is the first sentence's place in the document. Every chunk starts with the title in
    brackets, or with the document id. Blank windows are left out. Needs no shuffle.
    """
    step = max(1, chunk_size - 1)
    header = F.coalesce(F.nullif("title", F.lit("")), F.col("doc_id").cast("string"))
    split = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        header.alias("_header"),
        split_sentences(F.col("text")).alias("_sentences"),
    )
    starts = F.sequence(F.lit(0), F.size("_sentences") - 1, F.lit(step))
    windows = F.transform(
        starts,
        lambda i: F.struct(
            i.alias("pos"),
            F.array_join(F.slice("_sentences", i + 1, F.lit(chunk_size)), " ").alias("body"),
        ),
    )
    return (
        split.select("doc_id", "_header", F.inline(windows))
        .filter(~is_blank(F.col("body")))
        .select(
            chunk_id(F.col("doc_id"), F.col("pos")).alias("chunk_id"),
            "doc_id",
            "pos",
            F.concat(F.lit("["), F.col("_header"), F.lit("] "), F.col("body")).alias("text"),
        )
    )


def chunks_per_document(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("doc_id").agg(F.count(F.lit(1)).alias("chunks"))
