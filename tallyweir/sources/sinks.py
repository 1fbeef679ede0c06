"""Table sinks: schema-checked append, and published snapshots for keyed upserts.

A snapshot table has one writer at a time. The marker that publishes a version holds its schema, so that a version
without rows can be read, and versions beyond the last ``KEPT_VERSIONS`` are removed when a new one is published.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyweir.operators.merge import ACTION, conform, merge_into_delta, merge_metrics, merge_tagged
from tallyweir.session import key_passes, materialize, scratch_scope

PUBLISHED = "_PUBLISHED"
RECORDS_PER_FILE = 500_000  # of JSON lines; compressed files are read by one task each
COMPACT = "zstd"  # codec of tables that are kept
KEPT_VERSIONS = 3  # the newest one and those that long readers may still be on


def append_table(df: DataFrame, path: str, declared: StructType | None = None, fmt: str = "parquet") -> None:
    """Append; with a declared schema, a write that would change it is refused."""
    (conform(df, declared) if declared is not None else df).write.format(fmt).mode("append").save(path)


def write_documents(docs: DataFrame, path: str) -> None:
    """Documents as JSON lines, each task writing its own file."""
    docs.write.mode("overwrite").json(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    """Compressed JSON lines, in files of bounded size as no task can share one."""
    df.write.mode(mode).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).json(path)


def write_messages(messages: DataFrame, path: str) -> None:
    """(payload, source_offset, source_partition) as a folder that streams and batch reads accept."""
    write_json_lines(messages, path)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def published_versions(spark: SparkSession, root: str) -> list[int]:
    """The published versions under ``root``, oldest first."""
    fs, folder = _file_system(spark, root)
    if not fs.exists(folder):
        return []
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    folders = [status.getPath() for status in fs.listStatus(folder)]
    return sorted(
        int(path.getName()[2:])
        for path in folders
        if path.getName().startswith("v=") and fs.exists(hadoop_path(path, PUBLISHED))
    )


def latest_snapshot(spark: SparkSession, root: str) -> tuple[int, str] | None:
    """(version, path) of the newest published snapshot under ``root``; None before the first."""
    published = published_versions(spark, root)
    return (published[-1], f"{root}/v={published[-1]}") if published else None


def read_snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest published version of a table, or None. Its schema is the declared one, not read from files."""
    found = latest_snapshot(spark, root)
    if not found:
        return None
    fs, marker = _file_system(spark, f"{found[1]}/{PUBLISHED}")
    stream = fs.open(marker)
    try:
        schema = StructType.fromJson(json.loads(bytes(stream.readAllBytes())))
    finally:
        stream.close()
    return spark.read.schema(schema).parquet(found[1]).drop(ACTION)


def publish_snapshot(
    df: DataFrame,
    root: str,
    gate: Callable[[DataFrame], None] | None = None,
    partition_by: list[str] | None = None,
) -> DataFrame:
    """Write ``df`` as the next version, let ``gate`` look at it, then mark it as published.

    A gate that raises leaves the version before in place, and so does a write that fails. Readers of
    the last few older versions are not disturbed. Returns the stored rows.
    """
    path = _next_version(df.sparkSession, root)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return _publish(df.sparkSession, df.schema, root, path, gate)


def _next_version(spark: SparkSession, root: str) -> str:
    found = latest_snapshot(spark, root)
    return f"{root}/v={found[0] + 1 if found else 0}"


def _publish(
    spark: SparkSession, schema: StructType, root: str, path: str, gate: Callable[[DataFrame], None] | None
) -> DataFrame:
    """Judge what was written to ``path``, mark it as published and remove versions that are too old."""
    stored = spark.read.schema(schema).parquet(path)
    if gate is not None:
        gate(stored)
    fs, marker = _file_system(spark, f"{path}/{PUBLISHED}")
    out = fs.create(marker, True)
    out.write(bytearray(schema.json().encode()))
    out.close()
    for version in published_versions(spark, root)[:-KEPT_VERSIONS]:
        fs.delete(_file_system(spark, f"{root}/v={version}")[1], True)
    return stored


def upsert_table(
    source: DataFrame,
    root: str,
    keys: list[str],
    gate: Callable[[DataFrame], None] | None = None,
    stored: bool = False,
) -> DataFrame:
    """Create the snapshot table from ``source``, or merge it in; returns one row of merge counts.

    The merged rows are written once, in one folder per merge action, so the counts come from the
    stored files. ``source`` is stored first as the merge reads it several times, unless it is ``stored`` already.
    """
    spark = source.sparkSession
    source = source if stored else materialize(source, "merge_source")
    tagged = _tagged(read_snapshot(spark, root), source, keys)
    return merge_metrics(publish_snapshot(tagged, root, gate, [ACTION]), source)


def _tagged(target: DataFrame | None, source: DataFrame, keys: list[str]) -> DataFrame:
    return source.withColumn(ACTION, F.lit("inserted")) if target is None else merge_tagged(target, source, keys)


def upsert_in_passes(
    records: DataFrame,
    increment: Callable[[DataFrame, bool], DataFrame],
    root: str,
    keys: list[str],
    gate: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """``upsert_table`` for what ``increment`` makes of stored ``records``, which have the same keys.

    Records and table are gone through in passes, by key, so that only a part of both is shuffled and stored besides the
    table at a time. ``increment`` gets the records of a pass and whether it is the first; it returns stored rows, which are
    removed after the pass if it has materialized them.
    """
    spark = records.sparkSession
    target, path = read_snapshot(spark, root), _next_version(spark, root)
    source_rows, schema = 0, None
    for part in key_passes(records, keys):
        with scratch_scope(spark):
            source = increment(records.filter(part), schema is None)
            source_rows += source.count()
            tagged = _tagged(None if target is None else target.filter(part), source, keys)
            writer = tagged.write.mode("overwrite" if schema is None else "append")
            writer.option("compression", COMPACT).partitionBy(ACTION).parquet(path)
            schema = tagged.schema
    counts = merge_metrics(_publish(spark, schema, root, path, gate))
    return counts.withColumn("source_rows", F.lit(source_rows).cast("bigint"))


def upsert_delta(source: DataFrame, path: str, keys: list[str]) -> None:
    """Create-or-merge on a Delta table in place; needs a session with the Delta extension."""
    fs, log = _file_system(source.sparkSession, f"{path}/_delta_log")
    if fs.exists(log):
        merge_into_delta(source.sparkSession, path, source, keys)
    else:
        source.write.format("delta").save(path)
