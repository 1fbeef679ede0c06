import pytest
from pyspark.sql import functions as F

from tallyweir.operators.quality import (
    BRONZE_SUITE,
    SILVER_SUITE,
    QualityGateError,
    Suite,
    enforce,
    not_null,
    run_expectations,
    unique_keys,
    verdict,
)


def test_bronze_counts(spark):
    rows = [("536365", "a"), ("C536365", "b"), ("FREE", None), (None, "c"), ("FREE", "d")]
    df = spark.createDataFrame(rows, "InvoiceNo string, StockCode string")
    found = {r["position"]: r for r in run_expectations(df, BRONZE_SUITE).collect()}
    assert [found[i]["unexpected_count"] for i in range(3)] == [1, 1, 2]
    assert found[0]["missing_count"] is None
    assert found[2]["missing_count"] == 1
    assert found[2]["unexpected_percent"] == 50.0
    assert found[2]["unexpected_percent_total"] == 40.0
    assert found[2]["partial_unexpected_list"] == ["FREE", "FREE"]
    assert [tuple(c) for c in found[2]["partial_unexpected_counts"]] == [("FREE", 2)]
    assert found[1]["partial_unexpected_list"] == [None]


def test_every_row_of_a_repeated_key_is_unexpected(spark):
    silver = spark.range(6780).select(
        F.col("id").cast("string").alias("InvoiceNo"), F.lit("x").alias("StockCode"), F.current_timestamp().alias("invoice_ts")
    )
    damaged = silver.unionByName(silver.orderBy("InvoiceNo").limit(5))
    results = run_expectations(damaged, SILVER_SUITE)
    unique, times = results.orderBy("position").collect()
    assert (unique["element_count"], unique["unexpected_count"]) == (6785, 10)
    assert round(unique["unexpected_percent"], 4) == 0.1474
    assert [c["count"] for c in unique["partial_unexpected_counts"]] == [2] * 5
    assert len(unique["partial_unexpected_list"]) == 10
    assert times["success"]
    assert verdict(results).first().asDict() == {
        "suite": "silver_quality_suite", "success": False, "evaluated_expectations": 2,
        "successful_expectations": 1, "unsuccessful_expectations": 1, "success_percent": 50.0,
    }
    with pytest.raises(QualityGateError, match="10 of 6785"):
        enforce(results)
    enforce(run_expectations(silver, SILVER_SUITE))


def test_samples_are_bounded(spark):
    df = spark.range(10_000).select((F.col("id") % 100).alias("k"), F.lit(None).cast("string").alias("v"))
    unique, empty = run_expectations(df, Suite("s", (unique_keys("k"), not_null("v")))).orderBy("position").collect()
    assert unique["unexpected_count"] == empty["unexpected_count"] == 10_000
    assert len(unique["partial_unexpected_list"]) == len(unique["partial_unexpected_counts"]) == 20
    assert empty["partial_unexpected_list"] == [None] * 20


def test_keys_that_are_all_null_are_not_judged(spark):
    df = spark.createDataFrame([(None, None), (None, None), ("a", None), ("a", None)], "x string, y string")
    row = run_expectations(df, Suite("s", (unique_keys("x", "y"),))).first()
    assert (row["missing_count"], row["unexpected_count"], row["unexpected_percent"]) == (2, 2, 100.0)


def test_empty_table_passes(spark):
    df = spark.createDataFrame([], "InvoiceNo string, StockCode string")
    enforce(run_expectations(df, BRONZE_SUITE))
