import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from tallyweir.operators import changes, medallion, merge
from tallyweir.operators.rank import global_rank, top_n_per_group
from tallyweir.schemas import BUSINESS_COLUMNS, SILVER

LINE = ", ".join(
    f"{c} {dict(Quantity='bigint', UnitPrice='double').get(c, 'string')}" for c in BUSINESS_COLUMNS
)


def _lines(spark, rows):
    full = [(i, s, d, q, "12/1/2010 8:26", p, "17850", c) for i, s, d, q, p, c in rows]
    return spark.createDataFrame(full, LINE)


def _rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_route_keeps_null_codes_on_the_side(spark):
    lines = _lines(spark, [("1", c, "x", 1, 1.0, "A") for c in ("85123A", "85123", "POST", "8512", "85123AB", None)])
    products, others = medallion.route_products(lines)
    assert _rows(products, "StockCode") == [("85123",), ("85123A",)]
    assert _rows(others, "StockCode") == sorted([("8512",), ("85123AB",), ("POST",), (None,)], key=repr)


def test_cancellation_flag(spark):
    lines = _lines(spark, [(i, "1", "", q, 1.0, "") for i, q in (("536", 1), ("c536", 1), ("C536", 1), ("536", -1))])
    found = [r["is_cancellation"] for r in medallion.flag_cancellations(lines).collect()]
    assert found == [False, True, True, True]


def test_grain_rules(spark):
    lines = _lines(
        spark,
        [
            ("1", "11111", "b", 2, 3.0, "B"),
            ("1", "11111", "a", 1, 6.0, "A"),
            ("1", "11111", "a", 1, 6.0, "A"),  # an exact copy counts once
            ("2", "11111", "z", 5, 4.0, "A"),
            ("2", "11111", "z", -5, 2.0, "A"),
            ("2", "POST", "z", 1, 2.0, "A"),
        ],
    )
    grain, others = medallion.silver_increment(lines)
    found = _rows(grain, "InvoiceNo", "Quantity", "line_revenue", "UnitPrice", "Description", "Country", "is_cancellation")
    assert found == [("1", 3, 12.0, 4.0, "a", "A", False), ("2", 0, 10.0, 2.0, "z", "A", True)]
    assert others.count() == 1
    assert grain.schema.names == [f.name for f in SILVER] or set(grain.columns) == set(SILVER.names)


def test_totals_out_of_range_are_set_aside_and_stop_nothing(spark):
    big, infinite = 9 * 10**18, float("inf")
    lines = _lines(
        spark,
        [
            ("1", "11111", "a", big, 1.0, "A"),
            ("1", "11111", "b", big, 1.0, "A"),
            ("2", "11111", "a", big, 1.0, "A"),
            ("3", "11111", "a", big, 1.0, "A"),
            ("4", "22222", "a", 1, infinite, "A"),
            ("5", "22222", "a", 1, float("nan"), "A"),
            ("6", "22222", "a", 1, 0.1, "A"),
            ("7", "22222", "a", None, None, "A"),
            ("8", "POST", "a", 1, 1.0, "A"),
        ],
    )
    grain, aside = medallion.silver_increment(lines)
    assert _rows(grain, "InvoiceNo") == [("2",), ("3",), ("6",), ("7",)]
    reasons = [("1", medallion.OUT_OF_RANGE)] * 2 + [("4", medallion.OUT_OF_RANGE), ("5", medallion.OUT_OF_RANGE)]
    assert _rows(aside, "InvoiceNo", "reason") == reasons + [("8", medallion.NOT_A_PRODUCT)]
    gold = {r["StockCode"]: r["total_quantity"] for r in medallion.rank_products(grain).collect()}
    assert gold == {"11111": None, "22222": 1}  # the sum of two accepted rows may exceed 64 bits, too


def test_dedup_and_grain_share_one_shuffle(spark):
    lines = _lines(spark, [("1", "11111", "a", 1, 1.0, "A")])
    clustered = medallion.dedup_rows(lines, cluster_by=["InvoiceNo", "StockCode"])
    timed = medallion.flag_cancellations(clustered).withColumn("invoice_ts", F.current_timestamp())
    plan = medallion.roll_up(timed, medallion.grain_rule())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_revenue_does_not_depend_on_the_order_of_rows(spark):
    rows = [("1", "11111", f"d{i}", i % 7 + 1, 0.1 * i + 0.01, "A") for i in range(400)]
    sums = set()
    for parts in (1, 3, 7):
        grain, _ = medallion.silver_increment(_lines(spark, rows).repartition(parts))
        sums.add(grain.first()["line_revenue"])
    assert len(sums) == 1


def test_best_labels_of_any_columns(spark):
    df = spark.createDataFrame([("g", "x", 1), ("g", "y", 2), ("g", "z", 2), ("h", "x", None)], "g string, l string, w int")
    made = medallion.best_labels(df, ["g"], "l", F.sum("w"), 2, "best", "/")
    assert _rows(made, "g", "best") == [("g", "y/z"), ("h", "x")]


def test_products_are_ranked_with_their_best_countries(spark):
    rows = [("1", "11111", "one", 1, 5.0, c) for c in "A"] + [
        ("2", "11111", "one", 1, 7.0, "B"),
        ("3", "11111", "one", 1, 5.0, "C"),
        ("4", "11111", "one", 1, 5.0, "D"),
        ("5", "22222", "two", 2, 11.0, "A"),
        ("6", "33333", "tie", 2, 11.0, "A"),
        ("C7", "44444", "gone", 1, 99.0, "A"),
    ]
    grain, _ = medallion.silver_increment(_lines(spark, rows))
    gold = medallion.rank_products(grain)
    found = _rows(gold, "revenue_rank", "StockCode", "total_revenue", "num_invoices", "top_countries", "total_products")
    assert found == [
        (1, "11111", 22.0, 4, "B, A, C", 3),
        (2, "22222", 22.0, 1, "A", 3),
        (3, "33333", 22.0, 1, "A", 3),
    ]


@pytest.mark.parametrize("hot", [0.0, 0.4, 1.0])
def test_global_rank_numbers_every_row(spark, hot):
    rng = random.Random(7)
    rows = [(i, 5.0 if rng.random() < hot else rng.random() * 10) for i in range(3000)]
    df = spark.createDataFrame(rows, "id bigint, v double").repartition(7)
    ranked = global_rank(df, [F.desc("v"), F.asc("id")], output="r", total="n").collect()
    want = sorted(rows, key=lambda r: (-r[1], r[0]))
    assert [r["id"] for r in sorted(ranked, key=lambda r: r["r"])] == [i for i, _ in want]
    assert sorted(r["r"] for r in ranked) == list(range(1, 3001))
    assert {r["n"] for r in ranked} == {3000}


def test_global_rank_of_nothing(spark):
    assert global_rank(spark.createDataFrame([], "v int"), [F.asc("v")]).count() == 0


def test_top_n_limits_before_the_shuffle(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 3)
    top = top_n_per_group(df, ["g"], [F.desc("id")], 2)
    assert _rows(top, "g", "id", "rank") == [(0, 96, 2), (0, 99, 1), (1, 94, 2), (1, 97, 1), (2, 95, 2), (2, 98, 1)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


T = "k1 string, k2 string, v int"


@pytest.fixture(params=[True, False], ids=["broadcast", "shuffled"])
def join_size(request, monkeypatch):
    monkeypatch.setattr(merge, "is_small", lambda *_: request.param)


def test_merge_follows_update_all_insert_all(spark, join_size):
    target = spark.createDataFrame(
        [("a", "1", 1), ("b", "1", 2), ("b", "1", 3), ("c", "1", 4), (None, "1", 5)], T
    )
    source = spark.createDataFrame([("b", "1", 20), ("d", "1", 30), (None, "1", 40)], T)
    merged, metrics = merge.merge_upsert(target, source, ["k1", "k2"])
    assert _rows(merged, "k1", "v") == sorted(
        [("a", 1), ("b", 20), ("b", 20), ("c", 4), (None, 5), ("d", 30), (None, 40)], key=repr
    )
    assert metrics.first().asDict() == {
        "target_rows_updated": 2, "target_rows_inserted": 2, "source_rows": 3, "target_rows_copied": 3,
    }


def test_merging_twice_changes_nothing(spark, join_size):
    target = spark.createDataFrame([(str(i), "x", i) for i in range(50)], T)
    source = spark.createDataFrame([(str(i), "x", -i) for i in range(30, 70)], T)
    once, _ = merge.merge_upsert(target, source, ["k1", "k2"])
    twice, metrics = merge.merge_upsert(once, source, ["k1", "k2"])
    assert _rows(once, *once.columns) == _rows(twice, *once.columns)
    assert metrics.first()["target_rows_inserted"] == 0


def test_merge_refuses_ambiguous_source(spark, join_size):
    target = spark.createDataFrame([("a", "1", 1)], T)
    source = spark.createDataFrame([("a", "1", 2), ("a", "1", 3)], T)
    with pytest.raises(merge.AmbiguousMergeError):
        merge.merge_tagged(target, source, ["k1", "k2"])
    fresh = spark.createDataFrame([("z", "1", 2), ("z", "1", 3)], T)
    assert merge.merge_tagged(target, fresh, ["k1", "k2"]).count() == 3


def test_small_increment_does_not_shuffle_the_target(spark):
    target = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    source = spark.createDataFrame([(5, 2)], "k bigint, v int")
    kept = merge.merge_tagged(target, source, ["k"], check=False).filter("_action <> 'inserted'")
    assert "SortMergeJoin" not in kept._jdf.queryExecution().executedPlan().toString()


def test_delete_keeps_null_verdicts(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, gone boolean")
    assert _rows(merge.delete_where(df, F.col("gone")), "id") == [(2,), (3,)]
    assert merge.delete_counts(df, F.col("gone")).first() == (3, 1, 2)


def test_schema_guard(spark):
    row = spark.createDataFrame([], SILVER)
    assert merge.schema_diff(row, SILVER) == []
    extra = row.withColumn("discount", F.lit(99.9))
    assert merge.schema_diff(extra, SILVER) == [("discount", "undeclared", "double", None)]
    with pytest.raises(merge.SchemaMismatchError, match="discount"):
        merge.conform(extra, SILVER)
    with pytest.raises(merge.SchemaMismatchError, match="Quantity"):
        merge.conform(row.withColumn("Quantity", F.lit("x")), SILVER)
    shuffled = row.drop("CustomerID").select("Country", "InvoiceNo", *row.drop("CustomerID", "Country", "InvoiceNo").columns)
    assert merge.conform(shuffled, SILVER).schema.names == SILVER.names
    required = type(SILVER)([*SILVER.fields, StructField("must", DoubleType(), False)])
    with pytest.raises(merge.SchemaMismatchError, match="must"):
        merge.conform(row, required)


def test_correction_batch(spark):
    texts = spark.createDataFrame([(f"{i:02d}", str(i)) for i in range(9)] + [("09", "many")], "k string, Quantity string")
    parts = changes.row_slices(texts, [F.asc("k")], {"corrected": (0, 3), "added": (8, 10)})
    bad = spark.createDataFrame([("xx", "bad")], "k string, Quantity string")
    batch = changes.correction_batch(parts["corrected"], parts["added"], bad)
    assert _rows(batch, "k", "Quantity") == [("00", "0"), ("01", "2"), ("02", "4"), ("08", "8"), ("09", "many"), ("xx", "bad")]
    assert _rows(changes.double_quantity(texts.filter("k = '09'")), "Quantity") == [("many",)]


def test_injected_duplicates_can_be_deleted_again(spark):
    silver = spark.createDataFrame([(f"{i:02d}", "x", False) for i in range(20)], "InvoiceNo string, StockCode string, _injected boolean")
    damaged = changes.inject_duplicates(silver, 5, ["InvoiceNo", "StockCode"])
    assert damaged.count() == 25
    assert damaged.filter("_injected").count() == 5
    clean = merge.delete_where(damaged, F.col("_injected"))
    assert _rows(clean, *silver.columns) == _rows(silver, *silver.columns)
