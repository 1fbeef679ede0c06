"""Declared schemas of the layers. Nothing is inferred from files."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

BUSINESS_COLUMNS = [
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "UnitPrice",
    "CustomerID",
    "Country",
]
GRAIN_KEYS = ["InvoiceNo", "StockCode"]

RAW_TRANSACTION = StructType([StructField(name, StringType()) for name in BUSINESS_COLUMNS])

TRANSACTION = StructType(
    [
        StructField(
            name, {"Quantity": LongType(), "UnitPrice": DoubleType()}.get(name, StringType())
        )
        for name in BUSINESS_COLUMNS
    ]
)

LANDING = StructType(
    TRANSACTION.fields
    + [StructField("source_offset", LongType()), StructField("source_partition", IntegerType())]
)

MESSAGE = StructType(
    [
        StructField("payload", StringType()),
        StructField("source_offset", LongType()),
        StructField("source_partition", IntegerType()),
    ]
)

DEAD_LETTER = StructType(
    [
        StructField("rejected_record", RAW_TRANSACTION),
        StructField("payload", StringType()),
        StructField("rejection_reason", StringType()),
        StructField("failed_fields", ArrayType(StringType())),
        StructField("source_offset", LongType()),
        StructField("source_partition", IntegerType()),
    ]
)

#: Sums of revenue are exact, so that they do not depend on the order in which tasks finish.
REVENUE = "decimal(38,8)"

SILVER = StructType(
    [
        StructField("InvoiceNo", StringType()),
        StructField("StockCode", StringType()),
        StructField("Quantity", LongType()),
        StructField("line_revenue", DecimalType(38, 8)),
        StructField("invoice_ts", TimestampType()),
        StructField("Description", StringType()),
        StructField("CustomerID", StringType()),
        StructField("Country", StringType()),
        StructField("is_cancellation", BooleanType()),
        StructField("UnitPrice", DoubleType()),
        StructField("_injected", BooleanType()),
    ]
)

MERGE_COUNTS = StructType(
    [
        StructField("target_rows_updated", LongType()),
        StructField("target_rows_inserted", LongType()),
        StructField("source_rows", LongType()),
        StructField("target_rows_copied", LongType()),
    ]
)

DOCUMENT = StructType(
    [
        StructField("doc_id", StringType()),
        StructField("title", StringType()),
        StructField("text", StringType()),
    ]
)

RUN_EVENT = StructType(
    [
        StructField("event_type", StringType()),
        StructField("event_time", TimestampType()),
        StructField("run_id", StringType()),
        StructField("namespace", StringType()),
        StructField("job", StringType()),
        StructField("producer", StringType()),
    ]
)
