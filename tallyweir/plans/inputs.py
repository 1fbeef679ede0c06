"""Inputs of the registered queries, derived from the given tables by column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweir.functions.retail import format_invoice_date
from tallyweir.schemas import BUSINESS_COLUMNS
from tallyweir.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def retail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as retail transactions: the eight business columns, ``line_id`` and ``defect``.

    Returned items are cancellations with negative quantity, every 50th part is postage. Prices are
    exact decimals. ``defect`` (0 to 96) picks the lines that ``raw_messages`` damages.
    """
    # Texts are made on the small sides, once per part and per order. Lines are then shuffled twice, by part while
    # they are narrow and by order, however large the tables are.
    part, order = F.col("p_partkey"), F.col("o_orderkey")
    variant = F.when(part >= 100_000, F.char(F.lit(65) + (part / 100_000).cast("bigint") % 26)).otherwise("")
    parts = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(part % 50 == 0, "POST")
        .otherwise(F.concat(F.lpad((part % 100_000).cast("string"), 5, "0"), variant))
        .alias("StockCode"),
        F.upper("p_name").alias("Description"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("_price"),
    )
    series = F.when(order >= 1_000_000, F.char(F.lit(68) + (order / 1_000_000).cast("bigint") % 22)).otherwise("")
    minutes = F.make_dt_interval(mins=(order % 1440).cast("int"))
    orders = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "o_orderkey",
            series.alias("_series"),
            F.lpad((order % 1_000_000).cast("string"), 6, "0").alias("_number"),
            format_invoice_date(F.col("o_orderdate") + minutes).alias("InvoiceDate"),
            F.col("o_custkey").cast("string").alias("CustomerID"),
            F.col("n_name").alias("Country"),
        )
    )
    joined = (
        spread(table(spark, sf_dir, "lineitem"))
        .join(parts, F.col("l_partkey") == part)
        .join(orders, F.col("l_orderkey") == order)
    )
    returned = F.col("l_returnflag") == "R"
    line_order, line_part = F.col("l_orderkey"), F.col("l_partkey")
    price = F.col("_price") * (F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)"))
    return joined.select(
        (line_order * 10 + F.col("l_linenumber")).alias("line_id"),
        ((line_order * 31 + line_part * 7 + F.col("l_linenumber")) % 97).cast("int").alias("defect"),
        F.concat(F.when(returned, "C").otherwise(F.col("_series")), "_number").alias("InvoiceNo"),
        "StockCode",
        "Description",
        (F.when(returned, -1).otherwise(1) * F.col("l_quantity").cast("bigint")).alias("Quantity"),
        "InvoiceDate",
        price.cast("decimal(18,4)").alias("UnitPrice"),
        "CustomerID",
        "Country",
    )


def text_lines(lines: DataFrame) -> DataFrame:
    """The business columns as text, the way they come out of a CSV file."""
    return lines.select(*[F.col(c).cast("string").alias(c) for c in BUSINESS_COLUMNS])


def typed_lines(texts: DataFrame) -> DataFrame:
    return texts.withColumn("Quantity", F.col("Quantity").cast("bigint")).withColumn(
        "UnitPrice", F.col("UnitPrice").cast("decimal(18,4)")
    )


def _case(default: Column, **by_defect) -> Column:
    """``default``, or the value given for a defect number (as ``d<number>``)."""
    value = None
    for name, replacement in by_defect.items():
        test = F.col("defect") == int(name[1:])
        value = F.when(test, replacement) if value is None else value.when(test, replacement)
    return default if value is None else value.otherwise(default)


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(payload, source_offset, source_partition): one JSON message per line item, about a fifth of
    them odd: malformed, of another JSON type, padded, or with fields missing or null."""
    lines = retail_lines(spark, sf_dir)

    def quoted(text: Column) -> Column:
        return F.concat(F.lit('"'), text, F.lit('"'))

    missing = F.lit(None).cast("string")
    null = F.lit("null")
    invoice, quantity = F.col("InvoiceNo"), F.col("Quantity").cast("string")
    date, price = F.col("InvoiceDate"), F.col("UnitPrice").cast("string")
    values = {
        "InvoiceNo": _case(
            quoted(invoice), d0=F.lit('"FREE-STUFF"'), d8=quoted(F.concat(F.lit("  "), invoice, F.lit(" "))), d23=null
        ),
        "StockCode": _case(quoted(F.col("StockCode")), d4=F.lit('""'), d24=missing),
        "Description": _case(quoted(F.col("Description")), d6=null, d20=missing),
        "Quantity": _case(
            quoted(quantity),
            d2=F.lit('"many"'),
            d7=quoted(F.concat(quantity, F.lit(".0"))),
            d11=F.lit('"6.5"'),
            d13=quantity,
            d15=F.lit('"1_000"'),
            d16=F.concat(quantity, F.lit(".5")),
            d18=F.lit('" +7 "'),
        ),
        "InvoiceDate": _case(
            quoted(date),
            d1=F.lit('"not-a-date"'),
            d19=F.lit('"2/30/2010 8:26"'),
            d21=quoted(F.replace(date, F.lit(" "), F.lit("  "))),
        ),
        "UnitPrice": _case(quoted(price), d11=F.lit('"abc"'), d22=price),
        "CustomerID": _case(quoted(F.col("CustomerID")), d5=missing, d12=F.col("CustomerID")),
        "Country": _case(quoted(F.col("Country")), d3=F.lit('"   "'), d14=missing),
    }
    parts = [F.concat(F.lit(f'"{name}": '), value) for name, value in values.items()]
    record = F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))
    payload = _case(
        record, d9=F.lit('{"InvoiceNo": broken'), d10=F.lit('["not", "an", "object"]'), d17=F.lit("")
    )
    return lines.select(
        payload.alias("payload"),
        F.col("line_id").alias("source_offset"),
        (F.col("line_id") % 4).cast("int").alias("source_partition"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, title, text) of the text collection; it has no titles."""
    return spread(table(spark, sf_dir, "documents")).select(
        F.col("doc_id").cast("string").alias("doc_id"), F.lit(None).cast("string").alias("title"), "text"
    )


def benchmark_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, text): every benchmark item as a question to the text collection."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def catalog_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, text): questions to the product catalog, one per product name and per nation."""
    by_name = (
        table(spark, sf_dir, "part")
        .groupBy("p_name")
        .agg(F.min("p_partkey").alias("id"))
        .select(
            F.col("id").alias("query_id"),
            F.concat(F.lit("Tell me about "), F.col("p_name"), F.lit(" products")).alias("text"),
        )
    )
    by_nation = table(spark, sf_dir, "nation").select(
        (-F.col("n_nationkey").cast("bigint") - 1).alias("query_id"),
        F.concat(F.lit("Which product has the highest revenue in "), F.col("n_name"), F.lit("?")).alias("text"),
    )
    return by_name.unionByName(by_nation)


def stage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run events derived from the event table: the user is the run, the event type the job."""
    states = F.array(F.lit("START"), F.lit("COMPLETE"), F.lit("FAIL"))
    return table(spark, sf_dir, "events").select(
        F.element_at(states, (F.col("event_id") % 3 + 1).cast("int")).alias("event_type"),
        F.col("ts").alias("event_time"),
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"),
        F.lit("tallyweir").alias("namespace"),
        F.col("event_type").alias("job"),
        F.lit("tallyweir").alias("producer"),
    )
