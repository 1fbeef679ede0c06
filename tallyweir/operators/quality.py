"""Quality gates: expectations over a table as one result row each, and a verdict that can stop a run."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweir.functions.retail import INVOICE_NUMBER
from tallyweir.operators.rank import top_n_per_group
from tallyweir.session import key_passes, materialize, released_shuffles

SAMPLE_SIZE = 20
ROW, MISSING, UNEXPECTED = "row", "missing", "unexpected"

NOT_NULL = "expect_column_values_to_not_be_null"
MATCH_REGEX = "expect_column_values_to_match_regex"
UNIQUE_KEYS = "expect_compound_columns_to_be_unique"


class QualityGateError(RuntimeError):
    """A gate failed; whatever comes after it must not run."""


@dataclass(frozen=True)
class Expectation:
    kind: str
    columns: tuple[str, ...]
    regex: str | None = None
    position: int = 0

    @property
    def column_list(self) -> str:
        return ", ".join(self.columns)


@dataclass(frozen=True)
class Suite:
    name: str
    expectations: tuple[Expectation, ...]

    @property
    def columns(self) -> list[str]:
        """All that the expectations read; no other column needs to be stored for them."""
        return list(dict.fromkeys(c for e in self.expectations for c in e.columns))

    def numbered(self) -> list[Expectation]:
        return [replace(e, position=i) for i, e in enumerate(self.expectations)]


def not_null(column: str) -> Expectation:
    return Expectation(NOT_NULL, (column,))


def matches_regex(column: str, regex: str) -> Expectation:
    return Expectation(MATCH_REGEX, (column,), regex)


def unique_keys(*columns: str) -> Expectation:
    return Expectation(UNIQUE_KEYS, columns)


BRONZE_SUITE = Suite(
    "bronze_quality_suite",
    (
        not_null("InvoiceNo"),
        not_null("StockCode"),
        matches_regex("InvoiceNo", INVOICE_NUMBER),  # the same rule as the contract's
    ),
)
SILVER_SUITE = Suite(
    "silver_quality_suite", (unique_keys("InvoiceNo", "StockCode"), not_null("invoice_ts"))
)


def _missing(e: Expectation) -> Column:
    """Rows that the expectation does not judge: all of its columns are NULL."""
    if e.kind == NOT_NULL:
        return F.lit(False)
    return reduce(lambda a, b: a & b, [F.col(c).isNull() for c in e.columns])


def _unexpected(e: Expectation) -> Column:
    column = F.col(e.columns[0])
    if e.kind == NOT_NULL:
        return column.isNull()
    return column.isNotNull() & ~column.rlike(e.regex)


def _tally(df: DataFrame, expectations: list[Expectation]) -> DataFrame:
    """(position, finding, value, times): the row count (position -1), and what each expectation is missing for.

    One aggregate of plain counts, whatever the number of expectations.
    """
    judged = [e for e in expectations if e.kind != NOT_NULL]
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *(F.count_if(_missing(e)).alias(f"_m{e.position}") for e in judged)
    )
    found = [(-1, ROW, "_rows"), *((e.position, MISSING, f"_m{e.position}") for e in judged)]
    entries = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(finding).alias("finding"),
            F.lit(None).cast("string").alias("value"),
            F.col(column).alias("times"),
        )
        for position, finding, column in found
    ]
    return counts.select(F.inline(F.array(*entries)))


def _row_failures(df: DataFrame, e: Expectation) -> DataFrame:
    """(position, finding, value, times) of the values that fail a row-wise expectation; reads only its column."""
    value = F.col(e.columns[0]).cast("string").alias("value")
    failing = df.filter(_unexpected(e)).select(value).groupBy("value").agg(F.count(F.lit(1)).alias("times"))
    return failing.select(F.lit(e.position).alias("position"), F.lit(UNEXPECTED).alias("finding"), "value", "times")


def _key_failures(df: DataFrame, e: Expectation) -> DataFrame:
    """(position, value, times) of the keys held by more than one row."""
    return (
        df.filter(~_missing(e))
        .groupBy(*e.columns)
        .agg(F.count(F.lit(1)).alias("times"))
        .filter("times > 1")
        .select(
            F.lit(e.position).alias("position"),
            F.lit(UNEXPECTED).alias("finding"),
            F.to_json(F.struct(*e.columns), {"ignoreNullFields": "false"}).alias("value"),
            "times",
        )
    )


def _repeated_keys(df: DataFrame, e: Expectation) -> list[DataFrame]:
    """The failures of a table's keys, by parts of the keys if it is large; only one part is shuffled at a time."""
    parts = [_key_failures(df.filter(part), e) for part in key_passes(df, list(e.columns))]
    if len(parts) == 1:
        return parts
    with released_shuffles(df.sparkSession):
        return [materialize(part, "repeated-keys") for part in parts]


def run_expectations(df: DataFrame, suite: Suite) -> DataFrame:
    """One row per expectation of the suite.

    ``unexpected_count`` counts rows; every row of a repeated key is unexpected. Values that are
    missing are not judged, except by not-null, which has no missing values. The samples hold the
    20 smallest failing values (repeats included) and the 20 most frequent ones with their counts.

    All totals share one scan of plain counts. Each expectation reads the columns it names and keeps only what
    fails, so pass a stored table. What they found is stored, as the counts and both samples are drawn from it.
    """
    spark = df.sparkSession
    expectations = suite.numbered()
    failures = []
    for e in expectations:
        failures += _repeated_keys(df, e) if e.kind == UNIQUE_KEYS else [_row_failures(df, e)]
    tally = materialize(reduce(DataFrame.unionByName, [_tally(df, expectations), *failures]), "tally")
    failed = tally.filter(F.col("finding") == UNEXPECTED)
    missing = (
        tally.filter(F.col("finding") == MISSING).groupBy("position").agg(F.sum("times").alias("missing"))
    )
    rows = tally.filter(F.col("finding") == ROW).agg(F.sum("times")).first()[0] or 0

    frequent = top_n_per_group(failed, ["position"], [F.desc("times"), F.asc("value")], SAMPLE_SIZE, "_f")
    smallest = top_n_per_group(failed, ["position"], [F.asc("value")], SAMPLE_SIZE, "_s")
    sums = failed.groupBy("position").agg(F.sum("times").alias("unexpected"))
    by_count = frequent.groupBy("position").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("_f", "value", "times"))),
            lambda r: F.struct(r["value"].alias("value"), r["times"].alias("count")),
        ).alias("counts")
    )
    by_value = smallest.groupBy("position").agg(
        F.slice(
            F.flatten(
                F.transform(
                    F.array_sort(F.collect_list(F.struct("_s", "value", "times"))),
                    lambda r: F.array_repeat(r["value"], F.least(r["times"], F.lit(SAMPLE_SIZE)).cast("int")),
                )
            ),
            1,
            SAMPLE_SIZE,
        ).alias("values")
    )
    described = spark.createDataFrame(
        [(e.position, suite.name, e.kind, e.column_list, e.regex, e.kind == NOT_NULL) for e in expectations],
        "position int, suite string, expectation_type string, column_list string, regex string, "
        "judges_nulls boolean",
    )
    joined = (
        described.join(missing, "position", "left")
        .join(sums, "position", "left")
        .join(by_count, "position", "left")
        .join(by_value, "position", "left")
        .withColumn("element_count", F.lit(rows).cast("bigint"))
        .withColumn("missing_count", F.coalesce("missing", F.lit(0).cast("bigint")))
        .withColumn("unexpected_count", F.coalesce("unexpected", F.lit(0).cast("bigint")))
    )

    def percent(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part * F.lit(100.0) / whole).otherwise(F.lit(0.0))

    judged = F.col("element_count") - F.col("missing_count")
    hidden = F.col("judges_nulls")
    return joined.select(
        "suite",
        "position",
        "expectation_type",
        "column_list",
        "regex",
        (F.col("unexpected_count") == 0).alias("success"),
        "element_count",
        "unexpected_count",
        percent(F.col("unexpected_count"), judged).alias("unexpected_percent"),
        F.when(~hidden, F.col("missing_count")).alias("missing_count"),
        F.when(~hidden, percent(F.col("missing_count"), F.col("element_count"))).alias("missing_percent"),
        F.when(~hidden, percent(F.col("unexpected_count"), F.col("element_count"))).alias(
            "unexpected_percent_total"
        ),
        F.when(~hidden, percent(F.col("unexpected_count"), judged)).alias("unexpected_percent_nonmissing"),
        F.coalesce("values", F.array().cast("array<string>")).alias("partial_unexpected_list"),
        F.coalesce("counts", F.array().cast("array<struct<value:string,count:bigint>>")).alias(
            "partial_unexpected_counts"
        ),
    )


def verdict(results: DataFrame) -> DataFrame:
    """One row per suite: success and how many expectations held."""
    counts = results.groupBy("suite").agg(
        F.count(F.lit(1)).alias("evaluated_expectations"),
        F.count_if("success").alias("successful_expectations"),
    )
    evaluated, held = F.col("evaluated_expectations"), F.col("successful_expectations")
    return counts.select(
        "suite",
        (evaluated == held).alias("success"),
        "evaluated_expectations",
        "successful_expectations",
        (evaluated - held).alias("unsuccessful_expectations"),
        (held * F.lit(100.0) / evaluated).alias("success_percent"),
    )


def enforce(results: DataFrame) -> None:
    """Raise QualityGateError if any expectation failed. Reads one row per expectation."""
    failed = (
        results.filter(~F.col("success"))
        .select("suite", "expectation_type", "column_list", "unexpected_count", "element_count")
        .collect()
    )
    if failed:
        raise QualityGateError(
            "; ".join(
                f"{r.suite}: {r.expectation_type}({r.column_list}) failed for "
                f"{r.unexpected_count} of {r.element_count} rows"
                for r in failed
            )
        )
