"""One increment through all layers: messages, audit table, gates, keyed table, products, documents.

A failing gate raises before the table it guards is published, and nothing after it runs. What has
been taken in but not merged yet is kept by the second stream's checkpoint, so the next call
continues where a failed one stopped.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession

from tallyweir.operators.documents import chunk_sentences, product_documents
from tallyweir.operators.medallion import append_audit, product_totals, rank_totals, silver_increment
from tallyweir.operators.quality import BRONZE_SUITE, SILVER_SUITE, Suite, enforce, run_expectations
from tallyweir.operators.runlog import RunLog
from tallyweir.schemas import GRAIN_KEYS, LANDING, MERGE_COUNTS
from tallyweir.session import key_passes, materialize, scratch_scope
from tallyweir.sources.sinks import COMPACT, publish_snapshot, read_snapshot, upsert_in_passes
from tallyweir.streaming.ingest import each_batch, ingest_stream, message_stream


@dataclass(frozen=True)
class Layers:
    """The folders of one lakehouse."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"


def _judge(table: DataFrame, suite: Suite, layers: Layers, batch_id: int) -> None:
    """Store the gate's results, then stop the run if an expectation failed."""
    results = materialize(run_expectations(table, suite), "gate")
    results.write.mode("overwrite").parquet(f"{layers.path('gates')}/suite_name={suite.name}/batch_id={batch_id}")
    enforce(results)


def _merge_landed(spark: SparkSession, layers: Layers, log: RunLog) -> list[tuple]:
    """Merge all landed files that are new since the last call, as one increment; returns the counts."""
    counts: list[tuple] = []
    errors: list[Exception] = []

    def handle(batch: DataFrame, batch_id: int) -> None:
        try:
            # The increment is judged before it becomes part of the audit table. A replayed batch replaces its
            # own folders, so no table ever holds a row twice.
            with scratch_scope(batch.sparkSession):
                staged = materialize(append_audit(batch), "staged")
                with log.stage("gate_bronze"):
                    _judge(staged, BRONZE_SUITE, layers, batch_id)
                with log.stage("audit"):
                    bronze = f"{layers.path('bronze')}/batch_id={batch_id}"
                    staged.write.mode("overwrite").option("compression", COMPACT).parquet(bronze)
                    increment = batch.sparkSession.read.schema(LANDING).parquet(bronze)
            with log.stage("silver"), scratch_scope(batch.sparkSession):
                aside = f"{layers.path('non_product')}/batch_id={batch_id}"

                def fold(part: DataFrame, first: bool) -> DataFrame:
                    grain, others = silver_increment(part)
                    others.write.mode("overwrite" if first else "append").parquet(aside)
                    return grain

                merged = upsert_in_passes(
                    increment,
                    fold,
                    layers.path("silver"),
                    GRAIN_KEYS,
                    gate=lambda table: _judge(table, SILVER_SUITE, layers, batch_id),
                )
                stored = materialize(merged, "merge_counts")
                stored.write.mode("overwrite").json(f"{layers.path('merge_metrics')}/batch_id={batch_id}")
                counts.append(tuple(stored.first()))
        except Exception as error:
            errors.append(error)
            raise

    landed = spark.readStream.schema(LANDING).json(f"{layers.path('landing')}/*")
    query = each_batch(landed, layers.path("checkpoints/silver"), handle)
    try:
        query.awaitTermination()
    except StreamingQueryException:
        if errors:
            raise errors[0] from None
        raise
    return counts


def _product_totals(silver: DataFrame) -> DataFrame:
    """Stored totals of all products, a part of these shuffled at a time."""
    parts = [product_totals(silver.filter(part)) for part in key_passes(silver, ["StockCode"])]
    return reduce(DataFrame.unionByName, [materialize(part, "totals") for part in parts])


def run_increment(spark: SparkSession, messages: str, layers: Layers, log: RunLog) -> DataFrame:
    """Take in what is new in the message folder and bring every layer up to date.

    Returns one row of merge counts, or none if there was nothing new. The product table, documents
    and chunks are rebuilt from the keyed table on every call.
    """
    with log.stage("ingest"):
        ingest_stream(
            message_stream(spark, messages),
            layers.path("landing"),
            layers.path("dead_letters"),
            layers.path("checkpoints/landing"),
        ).awaitTermination()
    counts = _merge_landed(spark, layers, log)
    silver = read_snapshot(spark, layers.path("silver"))
    if silver is not None:
        with log.stage("gold"), scratch_scope(spark):
            gold = publish_snapshot(rank_totals(_product_totals(silver)), layers.path("gold"))
        with log.stage("documents"), scratch_scope(spark):
            docs = publish_snapshot(product_documents(gold), layers.path("documents"))
            publish_snapshot(chunk_sentences(docs), layers.path("chunks"))
    return spark.createDataFrame(counts, MERGE_COUNTS)
