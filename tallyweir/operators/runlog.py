"""Run log: stage events as rows of an append-only table, and their roll-up."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweir.schemas import RUN_EVENT

START, COMPLETE, FAIL = "START", "COMPLETE", "FAIL"


def run_id(text: str | None = None) -> str:
    """The id of a run: UUID text stays, other text maps to one fixed UUID, no text gives a new one."""
    if not text:
        return str(uuid.uuid4())
    try:
        return str(uuid.UUID(text))
    except ValueError:
        return str(uuid.uuid5(uuid.NAMESPACE_URL, text))


class RunLog:
    """Appends events of one run to a table folder; one small row per event."""

    def __init__(
        self, spark: SparkSession, path: str, run: str | None = None, namespace: str = "tallyweir",
        producer: str = "tallyweir",
    ) -> None:
        self.spark = spark
        self.path = path
        self.run = run_id(run)
        self.namespace = namespace
        self.producer = producer

    def emit(self, job: str, state: str) -> None:
        row = (state, datetime.now(UTC), self.run, self.namespace, job, self.producer)
        self.spark.createDataFrame([row], RUN_EVENT).coalesce(1).write.mode("append").json(self.path)

    def events(self) -> DataFrame:
        return self.spark.read.schema(RUN_EVENT).json(self.path)

    @contextmanager
    def stage(self, job: str):
        """START, then COMPLETE, or FAIL for anything raised, exits included; the error goes on."""
        self.emit(job, START)
        try:
            yield self
        except BaseException:
            self.emit(job, FAIL)
            raise
        self.emit(job, COMPLETE)


def run_summary(events: DataFrame) -> DataFrame:
    """Per run and job: first and last event, last state, duration, number of events.

    A final state outranks START where both carry the same time.
    """
    is_final = (F.col("event_type") != START).cast("int")
    latest = F.max(F.struct("event_time", is_final.alias("final"), "event_type"))
    return (
        events.groupBy("run_id", "job")
        .agg(
            F.min("event_time").alias("started_at"),
            F.max("event_time").alias("ended_at"),
            latest["event_type"].alias("state"),
            F.count(F.lit(1)).alias("events"),
        )
        .withColumn(
            "duration_us",
            F.timestamp_diff("MICROSECOND", F.col("started_at"), F.col("ended_at")),
        )
    )
