"""A keyed table in hash buckets: an upsert reads and rewrites only the buckets that its source touches.

Rows lie in folders by a hash of ``cluster_by``, some or all of the keys; with the invoice alone, an increment touches
about as many buckets as it has invoices, and a large table needs more buckets than that. The merged rows of the touched
buckets are written once, to staged folders beside the table's, counted on the way and judged; then these folders take the
place of the old ones. The files of all other buckets are not opened. One writer at a time. A run that dies while folders
are replaced leaves those not yet moved under their staging folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tallyweir.operators.merge import ACTION, AmbiguousMergeError, SchemaMismatchError
from tallyweir.session import materialize
from tallyweir.sources.sinks import _file_system

MARKER = "_KEYED"
BUCKET = "_bucket"
BUCKETS = 64
COUNTS = "target_rows_updated long, target_rows_inserted long, source_rows long, target_rows_copied long"


@dataclass(frozen=True)
class KeyedTable:
    """The table under ``root``; see ``create_keyed`` and ``open_keyed``."""

    spark: SparkSession
    root: str
    keys: list[str]
    cluster_by: list[str]
    buckets: int
    schema: StructType

    def _placed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*self.cluster_by), F.lit(self.buckets)).cast("int"))

    def _stored(self) -> DataFrame:
        whole = StructType([*self.schema.fields, StructField(BUCKET, IntegerType())])
        return self.spark.read.schema(whole).parquet(self.root)

    def read(self) -> DataFrame:
        return self._stored().drop(BUCKET)

    def lookup(self, wanted: DataFrame) -> DataFrame:
        """The rows whose keys are in ``wanted`` (keys); other buckets are not listed."""
        placed = materialize(self._placed(wanted.select(*self.keys).distinct()), "wanted-keys")
        found = self._stored().filter(F.col(BUCKET).isin(self._buckets_of(placed)))
        return found.join(placed, [BUCKET, *self.keys], "left_semi").drop(BUCKET)

    def _buckets_of(self, placed: DataFrame) -> list[int]:
        """No more than the table has."""
        return sorted(r[BUCKET] for r in placed.select(BUCKET).distinct().collect())

    def _merged(self, source: DataFrame, touched: list[int]) -> DataFrame:
        """Rows of the touched buckets, each tagged updated, inserted or copied; both sides are dealt out once, by bucket."""
        target = self._stored().filter(F.col(BUCKET).isin(touched)).withColumn("_new", F.lit(False))
        both = target.unionByName(source.withColumn("_new", F.lit(True))).repartition(BUCKET)
        same_key = Window.partitionBy(BUCKET, *self.keys)
        counted = both.withColumns({"_n": F.count_if("_new").over(same_key), "_m": F.count_if(~F.col("_new")).over(same_key)})
        keyed = reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in self.keys])
        matched = keyed & (F.col("_n") > 0) & (F.col("_m") > 0)
        # a matched source row takes the place of every target row with its key
        times = F.when(~matched, 1).when(F.col("_new"), F.col("_m").cast("int")).otherwise(0)
        action = F.when(~F.col("_new"), "copied").when(matched, "updated").otherwise("inserted")
        tagged = counted.select(
            *self.schema.names, BUCKET, action.alias(ACTION), (matched & (F.col("_n") > 1)).alias("_clash"), times.alias("_times")
        )
        return tagged.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("_times")))).drop("_times", "_copy")

    def _is_empty(self) -> bool:
        fs, root = _file_system(self.spark, self.root)
        return not any(status.getPath().getName().startswith(f"{BUCKET}=") for status in fs.listStatus(root))

    def upsert(self, source: DataFrame, gate: Callable[[DataFrame], None] | None = None) -> DataFrame:
        """Merge ``source`` in and return one row of merge counts; copied counts rows of touched buckets only.

        Update-all and insert-all: matched rows take over all columns of the source, rows with a NULL key never match.
        ``gate`` gets the table as it would be; if it raises, or a target row has two source rows, nothing changes.
        The first load of a table reads ``source`` once and matches nothing, so it is written as it is dealt out.
        """
        if set(source.columns) != set(self.schema.names):
            raise SchemaMismatchError(f"columns differ: {sorted(self.schema.names)} / {sorted(source.columns)}")
        placed = self._placed(source.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema)))
        touched: list[int] = []
        if self._is_empty():
            tagged = placed.repartition(BUCKET).withColumns({ACTION: F.lit("inserted"), "_clash": F.lit(False)})
        else:
            placed = materialize(placed, "keyed-source")
            touched = self._buckets_of(placed)
            if not touched:
                if gate is not None:
                    gate(self.read())
                return self.spark.createDataFrame([(0, 0, 0, 0)], COUNTS)
            tagged = self._merged(placed, touched)
        staged = f"{self.root}/_staged-{uuid.uuid4().hex}"
        fs, staged_path = _file_system(self.spark, staged)
        try:
            counts = self._stage(tagged, staged)
            if counts["clash"] is not None:
                raise AmbiguousMergeError(f"several source rows match target key {json.loads(counts['clash'])}")
            if gate is not None:
                others = self._stored().filter(~F.col(BUCKET).isin(touched)) if touched else self._stored()
                rows = self.spark.read.schema(self._stored().schema).parquet(staged)
                gate(others.unionByName(rows).drop(BUCKET))
        except BaseException:
            fs.delete(staged_path, True)
            raise
        _replace(self.spark, staged, self.root)
        source_rows = placed.count() if touched else counts["inserted"]
        return self.spark.createDataFrame([(counts["updated"], counts["inserted"], source_rows, counts["copied"])], COUNTS)

    def _stage(self, tagged: DataFrame, path: str) -> dict:
        """Write the rows by bucket; their counts by action and a key that has several source rows, if any, come from the same pass."""
        seen = Observation()
        clash = F.max(F.when(F.col("_clash"), F.to_json(F.struct(*self.keys))))
        counts = [F.count_if(F.col(ACTION) == name).alias(name) for name in ("updated", "inserted", "copied")]
        rows = tagged.observe(seen, clash.alias("clash"), *counts).drop(ACTION, "_clash")
        rows.write.partitionBy(BUCKET).parquet(path)
        return seen.get


def _replace(spark: SparkSession, staged: str, root: str) -> None:
    """Put the staged buckets in the place of those under ``root``."""
    fs, staged_path = _file_system(spark, staged)
    for status in fs.listStatus(staged_path):
        path = status.getPath()
        if not path.getName().startswith(f"{BUCKET}="):
            continue
        _, old = _file_system(spark, f"{root}/{path.getName()}")
        fs.delete(old, True)
        if not fs.rename(path, old):
            raise OSError(f"{path} could not be moved to {old}")
    fs.delete(staged_path, True)


def create_keyed(
    spark: SparkSession, root: str, schema: StructType, keys: list[str], cluster_by: list[str] | None = None, buckets: int = BUCKETS
) -> KeyedTable:
    """An empty table; its layout is settled here and kept in a marker beside the buckets."""
    cluster_by = cluster_by or keys
    if not set(cluster_by) <= set(keys) <= set(schema.names):
        raise SchemaMismatchError("a table is clustered by its keys, and keys are columns")
    layout = {"keys": keys, "cluster_by": cluster_by, "buckets": buckets, "schema": json.loads(schema.json())}
    fs, marker = _file_system(spark, f"{root}/{MARKER}")
    out = fs.create(marker, False)
    out.write(bytearray(json.dumps(layout).encode()))
    out.close()
    return KeyedTable(spark, root, keys, cluster_by, buckets, schema)


def open_keyed(spark: SparkSession, root: str) -> KeyedTable | None:
    """The table under ``root``, or None if there is none."""
    fs, marker = _file_system(spark, f"{root}/{MARKER}")
    if not fs.exists(marker):
        return None
    stream = fs.open(marker)
    try:
        layout = json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()
    return KeyedTable(
        spark, root, layout["keys"], layout["cluster_by"], layout["buckets"], StructType.fromJson(layout["schema"])
    )
