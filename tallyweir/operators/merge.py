"""Keyed upsert, predicate delete and schema guard."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyweir.session import is_small

ACTION = "_action"


class AmbiguousMergeError(ValueError):
    """Several source rows match the same target row."""


class SchemaMismatchError(ValueError):
    """A write does not fit the declared schema."""


def _match(left: str, right: str, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}") == F.col(f"{right}.{k}") for k in keys])


def merge_tagged(
    target: DataFrame, source: DataFrame, keys: list[str], check: bool = True, unique: bool = False
) -> DataFrame:
    """Rows of the merged table, each tagged updated, inserted or copied.

    Every target row that shares its key with the source takes over all source columns, also where
    the target holds a key more than once; other target rows stay; other source rows are added. Keys
    with a NULL never match. Raises AmbiguousMergeError if a target row has two source rows.

    A small source (the usual increment) is broadcast, and the target is then never shuffled.
    Otherwise both joins keep the target on the left, the side whose hot keys Spark can split.

    With ``unique``, both sides hold every key once, as a table rolled up by its keys does. Then no key is hot and nothing
    is to be checked: each side is read once, for one full join, and need not be stored.
    """
    if set(target.columns) != set(source.columns):
        raise SchemaMismatchError(f"columns differ: {sorted(target.columns)} / {sorted(source.columns)}")
    if unique:
        return _merge_unique(target, source, keys)
    small = is_small(source)
    updates = F.broadcast(source) if small else source

    if check:
        repeated = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*keys)
        repeated = F.broadcast(repeated) if small else repeated
        clash = target.select(*keys).join(repeated, keys, "left_semi").limit(1).collect()
        if clash:
            raise AmbiguousMergeError(f"several source rows match target key {clash[0].asDict()}")

    columns = target.columns
    tagged_source = updates.withColumn("_hit", F.lit(True))
    joined = target.alias("t").join(tagged_source.alias("s"), _match("t", "s", keys), "left")
    hit = F.col("s._hit").isNotNull()
    kept = joined.select(
        *[F.when(hit, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in columns],
        F.when(hit, "updated").otherwise("copied").alias(ACTION),
    )
    source_keys = F.broadcast(source.select(*keys)) if small else source.select(*keys)
    present = target.select(*keys).join(source_keys, keys, "left_semi").distinct()
    if small:
        present = F.broadcast(present)  # no more rows than the source has keys
    added = source.alias("s").join(present.alias("t"), _match("s", "t", keys), "left_anti")
    return kept.unionByName(added.withColumn(ACTION, F.lit("inserted")))


def _merge_unique(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    old, new = target.withColumn("_in", F.lit(True)), source.withColumn("_in", F.lit(True))
    joined = old.alias("t").join(new.alias("s"), _match("t", "s", keys), "full_outer")
    hit, known = F.col("s._in").isNotNull(), F.col("t._in").isNotNull()
    return joined.select(
        *[F.when(hit, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in target.columns],
        F.when(hit & known, "updated").when(hit, "inserted").otherwise("copied").alias(ACTION),
    )


def merge_metrics(tagged: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """One row of counts. Copied counts all target rows the merge left as they were.

    Without ``source``, the keys were unique on both sides: every source row has updated or inserted one row.
    """
    rows = tagged.select(ACTION)
    if source is not None:
        rows = rows.unionByName(source.select(F.lit("source").alias(ACTION)))

    def count(*actions: str) -> Column:
        return F.count_if(F.col(ACTION).isin(*actions))

    return rows.agg(
        count("updated").alias("target_rows_updated"),
        count("inserted").alias("target_rows_inserted"),
        (count("source") if source is not None else count("updated", "inserted")).alias("source_rows"),
        count("copied").alias("target_rows_copied"),
    )


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(merged table, metrics row)."""
    tagged = merge_tagged(target, source, keys)
    return tagged.drop(ACTION), merge_metrics(tagged, source)


def merge_into_delta(spark: SparkSession, path: str, source: DataFrame, keys: list[str]) -> None:
    """The same upsert on a Delta table in place; needs a session with the Delta extension."""
    source.createOrReplaceTempView("_merge_source")
    condition = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    spark.sql(
        f"MERGE INTO delta.`{path}` t USING _merge_source s ON {condition} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """``df`` without the rows for which ``predicate`` is true; a NULL verdict keeps the row."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def delete_counts(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows before, removed and after a delete, from a single scan."""
    removed = F.count_if(F.coalesce(predicate, F.lit(False)))
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("rows_before"), removed.alias("rows_removed"), (total - removed).alias("rows_after")
    )


def schema_diff(df: DataFrame, declared: StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(column, problem, type written, type declared) for every column that does not fit.

    Problems: ``undeclared``, ``type_mismatch``, ``missing`` (a missing column that may be NULL is fine
    to write and is filled).
    """
    wanted = {f.name: f for f in declared}
    found = {f.name: f for f in df.schema}
    problems = []
    for name, f in found.items():
        if name not in wanted:
            problems.append((name, "undeclared", f.dataType.simpleString(), None))
        elif wanted[name].dataType != f.dataType:
            problems.append(
                (name, "type_mismatch", f.dataType.simpleString(), wanted[name].dataType.simpleString())
            )
    for name, f in wanted.items():
        if name not in found:
            problems.append((name, "missing", None, f.dataType.simpleString()))
    return problems


def conform(df: DataFrame, declared: StructType) -> DataFrame:
    """``df`` in the declared column order, ready to append; refuses what would change the schema."""
    fatal = [
        p for p in schema_diff(df, declared) if p[1] != "missing" or not declared[p[0]].nullable
    ]
    if fatal:
        raise SchemaMismatchError(
            "write refused: " + "; ".join(f"{p[0]} {p[1]} ({p[2]} -> {p[3]})" for p in fatal)
        )
    return df.select(
        *[
            F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in declared
        ]
    )
