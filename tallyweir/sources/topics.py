"""Message topics as sources and sinks; a session needs Spark's Kafka connector for these."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _messages(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("value").cast("string").alias("payload"),
        F.col("offset").alias("source_offset"),
        F.col("partition").alias("source_partition"),
    )


def topic_stream(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """New messages of a topic, from its beginning on the first run; the checkpoint keeps offsets."""
    return _messages(
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
    )


def topic_dump(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Everything a topic holds now."""
    return _messages(
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("endingOffsets", "latest")
        .load()
    )


def write_topic(df: DataFrame, servers: str, topic: str, retries: int = 5) -> None:
    """Send every row as one JSON message."""
    (
        to_json_payload(df)
        .select(F.col("payload").alias("value"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.retries", str(retries))
        .option("topic", topic)
        .save()
    )


def to_json_payload(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Add ``payload``: the given columns (all by default) as one JSON object per row."""
    return df.withColumn(
        "payload", F.to_json(F.struct(*(columns or df.columns)), {"ignoreNullFields": "false"})
    )
