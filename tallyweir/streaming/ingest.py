"""Ingestion of message streams through the contract, with a checkpoint in place of offsets and renames."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyweir.operators.contract import (
    RETAIL_TRANSACTION,
    Contract,
    accepted_records,
    apply_contract,
    needed_parts,
    rejected_records,
)
from tallyweir.operators.medallion import silver_increment
from tallyweir.schemas import GRAIN_KEYS, MESSAGE
from tallyweir.session import materialize, scratch_scope
from tallyweir.sources.sinks import COMPACT, upsert_in_passes, write_json_lines

FILES_PER_BATCH = 1000


def message_stream(spark: SparkSession, path: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """A folder of message files as a stream; a backlog is worked off in batches of bounded size."""
    return spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", files_per_batch).json(path)


def each_batch(messages: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Run ``handle`` over everything that is there now, then stop."""
    return (
        messages.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_stream(
    messages: DataFrame,
    landing: str,
    dead_letters: str,
    checkpoint: str,
    contract: Contract = RETAIL_TRANSACTION,
) -> StreamingQuery:
    """Accepted records to ``landing``, rejected messages to ``dead_letters``, both as JSON lines.

    A batch that is replayed after a failure overwrites its own ``batch_id`` folder, so every message
    is in the output exactly once.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            checked = materialize(needed_parts(apply_contract(batch, contract)), "checked")
            for records, root in ((accepted_records(checked), landing), (rejected_records(checked), dead_letters)):
                write_json_lines(records, f"{root}/batch_id={batch_id}", "overwrite")

    return each_batch(messages, checkpoint, handle)


def merge_stream(
    records: DataFrame, silver_root: str, side_root: str, checkpoint: str, increment: str | None = None
) -> StreamingQuery:
    """Fold landed records into the keyed silver table; rows set aside go to a side folder.

    All batches of one ``increment`` count as one: its lines add up, however many batches bring them, and what
    the increment holds of a key replaces what the table had. Without an id, every call is an increment of its
    own. Its records are kept under ``side_root``, and each batch merges all of them that have arrived, so the
    result depends neither on the batch size nor on a replay.
    """
    name = increment or uuid.uuid4().hex
    arrived, aside = f"{side_root}/records/increment={name}", f"{side_root}/aside/increment={name}"

    def fold(part: DataFrame, first: bool) -> DataFrame:
        grain, others = silver_increment(part)
        others.write.mode("overwrite" if first else "append").parquet(aside)
        return grain

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        batch.write.mode("overwrite").option("compression", COMPACT).parquet(f"{arrived}/batch_id={batch_id}")
        whole = batch.sparkSession.read.schema(batch.schema).parquet(f"{arrived}/*")
        with scratch_scope(batch.sparkSession):
            upsert_in_passes(whole, fold, silver_root, GRAIN_KEYS)

    return each_batch(records, checkpoint, handle)
