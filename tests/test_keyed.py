"""The bucketed table against the merge of whole tables, and which files an upsert leaves alone."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyweir.operators import merge
from tallyweir.sources import keyed

SCHEMA = "a string, b long, v string"
KEYS = ["a", "b"]


def _table(spark, tmp_path, rows, buckets=16):
    df = spark.createDataFrame(rows, SCHEMA)
    table = keyed.create_keyed(spark, str(tmp_path / "t"), df.schema, KEYS, ["a"], buckets)
    table.upsert(df)
    return table


def _files(tmp_path):
    return {str(p): (p.stat().st_mtime_ns, p.stat().st_size) for p in Path(tmp_path / "t").rglob("*.parquet")}


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


OLD = [(f"k{i % 40}", i, f"old{i}") for i in range(200)] + [("k1", 1, "twice"), (None, 5, "no key"), ("k2", None, "no key")]


def test_upsert_equals_the_merge_of_whole_tables(spark, tmp_path):
    table = _table(spark, tmp_path, OLD)
    assert _rows(table.read()) == sorted(OLD, key=repr)
    source = spark.createDataFrame(
        [("k1", 1, "new"), ("k2", 2, None), ("k3", 999, "added"), ("z", 1, "a"), ("z", 1, "b"), (None, 5, "new"), ("k2", None, "new")], SCHEMA
    )
    expected = merge.merge_tagged(spark.createDataFrame(OLD, SCHEMA), source, KEYS)
    counts = table.upsert(source).first()
    assert _rows(table.read()) == _rows(expected.drop(merge.ACTION))
    assert (counts["target_rows_updated"], counts["target_rows_inserted"], counts["source_rows"]) == (3, 5, 7)
    assert table.upsert(source.filter("a = 'k3'")).first()["target_rows_updated"] == 1
    assert _rows(keyed.open_keyed(spark, table.root).read()) == _rows(expected.drop(merge.ACTION))


def test_files_of_untouched_buckets_stay_and_are_not_read(spark, tmp_path):
    table = _table(spark, tmp_path, OLD)
    before = _files(tmp_path)
    source = spark.createDataFrame([("k7", 7, "x"), ("k7", 1007, "y")], SCHEMA)
    plan = table._merged(table._placed(source), [3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan.replace("\n", "") or "PartitionFilters: [(_bucket" in plan
    counts = table.upsert(source).first()
    after = _files(tmp_path)
    assert sum(before.get(f) == s for f, s in after.items()) == len(before) - 1
    assert counts["target_rows_copied"] < 60
    wanted = spark.createDataFrame([("k7", 1007, None), ("nowhere", 1, None)], SCHEMA)
    assert _rows(table.lookup(wanted)) == [("k7", 1007, "y")]


def test_a_clash_a_failed_gate_or_other_columns_change_nothing(spark, tmp_path):
    table = _table(spark, tmp_path, OLD)
    before = _files(tmp_path)
    with pytest.raises(merge.AmbiguousMergeError):
        table.upsert(spark.createDataFrame([("k1", 1, "x"), ("k1", 1, "y")], SCHEMA))

    def gate(df):
        assert df.count() == len(OLD) + 1
        raise ValueError("failed")

    with pytest.raises(ValueError, match="failed"):
        table.upsert(spark.createDataFrame([("new", 1, "x")], SCHEMA), gate)
    with pytest.raises(merge.SchemaMismatchError):
        table.upsert(spark.createDataFrame([("new", 1)], "a string, b long"))
    with pytest.raises(merge.SchemaMismatchError):
        keyed.create_keyed(spark, str(tmp_path / "u"), table.schema, ["a"], ["v"])
    assert _files(tmp_path) == before
    assert keyed.open_keyed(spark, str(tmp_path / "none")) is None


def test_empty_sources_and_a_hot_key(spark, tmp_path):
    table = _table(spark, tmp_path, [("hot", i % 50, str(i)) for i in range(300)] + [(f"c{i}", i, "c") for i in range(50)])
    counts = table.upsert(table.read().filter("false")).first()
    assert counts["target_rows_copied"] == 0 and table.read().count() == 350
    table.upsert(spark.createDataFrame([("hot", 7, "all six")], SCHEMA))
    assert table.read().filter(F.col("v") == "all six").count() == 6


def test_rows_are_dealt_out_by_bucket_once_and_written_once(spark, tmp_path, monkeypatch):
    """A first load is one write of its source; a merge deals both sides out by bucket, without a join; nothing staged is left."""
    stored, real = [], keyed.materialize
    monkeypatch.setattr(keyed, "materialize", lambda df, label: stored.append(label) or real(df, label))
    table = _table(spark, tmp_path, OLD)
    assert stored == []
    source = spark.createDataFrame([("k1", 1, "new"), ("k9", 5000, "added")], SCHEMA)
    plan = table._merged(table._placed(source), [3])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
    assert table.upsert(source).first() == (2, 1, 2, table.read().count() - 3 - _untouched(table, source))
    assert stored == ["keyed-source"]
    with pytest.raises(merge.AmbiguousMergeError, match="k1"):
        table.upsert(spark.createDataFrame([("k1", 1, "x"), ("k1", 1, "y")], SCHEMA))
    assert not list((tmp_path / "t").glob("_staged*"))
    empty = keyed.create_keyed(spark, str(tmp_path / "e"), table.schema, KEYS)
    assert empty.upsert(source.filter("false")).first() == (0, 0, 0, 0) and empty.read().isEmpty()
    assert empty.upsert(source).first() == (0, 2, 2, 0) and _rows(empty.read()) == _rows(source)


def _untouched(table, source):
    touched = table._buckets_of(table._placed(source))
    return table._stored().filter(~F.col(keyed.BUCKET).isin(touched)).count()
