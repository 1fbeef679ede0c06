import json
import uuid

import pytest
from pyspark.sql import functions as F

from tallyweir.operators import quality, runlog
from tallyweir.operators.contract import RETAIL_TRANSACTION, accepted_records, apply_contract, rejected_records
from tallyweir.operators.medallion import append_audit, silver_increment
from tallyweir.plans import layered
from tallyweir.schemas import BUSINESS_COLUMNS, LANDING, SILVER
from tallyweir.session import is_small, materialize, spread
from tallyweir.sources import files, sinks, topics
from tallyweir.streaming.ingest import ingest_stream, merge_stream, message_stream


def _record(invoice, code, quantity, price="2.00", country="France"):
    return {
        "InvoiceNo": invoice, "StockCode": code, "Description": f"ITEM {code}", "Quantity": str(quantity),
        "InvoiceDate": "12/1/2010 8:26", "UnitPrice": price, "CustomerID": "1", "Country": country,
    }


def _send(spark, path, records, first_offset=0):
    rows = [(r if isinstance(r, str) else json.dumps(r), first_offset + i, 0) for i, r in enumerate(records)]
    messages = spark.createDataFrame(rows, "payload string, source_offset bigint, source_partition int")
    sinks.write_messages(messages, path)
    return messages


def _rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


BATCH_A = [_record(f"{536000 + i}", f"{10000 + i % 7}", i + 1) for i in range(50)] + [
    _record("536000", "POST", 1), "{bad", _record("FREE", "10001", 1), _record("536001", "10001", "many"),
]


def test_stream_equals_batch_and_replay_adds_nothing(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path)
    first = _send(spark, source, BATCH_A)
    second = _send(spark, source, [_record("537000", "10003", 9), "[]"], 1000)
    paths = (f"{out}/landing", f"{out}/dead")
    for checkpoint in ("one", "two"):  # the second run starts over, as after a lost checkpoint
        ingest_stream(message_stream(spark, source), *paths, f"{out}/{checkpoint}").awaitTermination()
    checked = apply_contract(first.unionByName(second), RETAIL_TRANSACTION)
    landed = files.scan_landing(spark, paths[0])
    assert _rows(landed, *LANDING.names) == _rows(accepted_records(checked), *LANDING.names)
    rejects = files.read_rejects(spark, paths[1])
    wanted = rejected_records(checked)
    columns = ["rejected_record.InvoiceNo", "payload", "rejection_reason", "source_offset"]
    assert _rows(rejects, *columns) == _rows(wanted, *columns) and wanted.count() == 4


def test_only_new_messages_are_read(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path)
    args = (f"{out}/landing", f"{out}/dead", f"{out}/checkpoint")
    for i in range(3):
        _send(spark, source, [_record("536000", f"1000{i}", 1)], i)
        ingest_stream(message_stream(spark, source, 1), *args).awaitTermination()
        assert files.scan_landing(spark, args[0]).count() == i + 1


def test_merge_stream_replaces_across_batches(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path)
    stream = lambda: spark.readStream.schema(LANDING).json(landing)
    args = (f"{root}/silver", f"{root}/side", f"{root}/checkpoint")
    for quantity in (2, 5):
        records = [(_record("536000", "10000", quantity) | {"Quantity": quantity, "UnitPrice": 2.0}), ]
        rows = [tuple(r[c] for c in BUSINESS_COLUMNS) + (0, 0) for r in records]
        spark.createDataFrame(rows, LANDING).write.mode("append").json(landing)
        merge_stream(stream(), *args).awaitTermination()
    silver = sinks.read_snapshot(spark, args[0])
    assert _rows(silver, "InvoiceNo", "StockCode", "Quantity", "line_revenue") == [("536000", "10000", 5, 10.0)]


def test_the_batch_size_does_not_change_an_increment(spark, tmp_path):
    """Lines of one key in several files add up within an increment, and replace the one before."""
    found = []
    for files_per_batch in (1, 100):
        root = str(tmp_path / str(files_per_batch))
        for day, quantities in enumerate(((3, 4), (5, 6, 7))):
            landing = f"{root}/landing{day}"
            for q in quantities:
                record = _record("536000", "10000", q) | {"Quantity": q, "UnitPrice": 2.0, "Description": f"line {q}"}
                row = tuple(record[c] for c in BUSINESS_COLUMNS) + (0, 0)
                spark.createDataFrame([row], LANDING).coalesce(1).write.mode("append").json(landing)
            stream = spark.readStream.schema(LANDING).option("maxFilesPerTrigger", files_per_batch).json(landing)
            args = (f"{root}/silver", f"{root}/side", f"{root}/checkpoint{day}", f"day{day}")
            merge_stream(stream, *args).awaitTermination()
            found.append(_rows(sinks.read_snapshot(spark, args[0]), "Quantity", "line_revenue"))
    assert found == [[(7, 14.0)], [(18, 36.0)]] * 2


def test_odd_but_accepted_messages_do_not_stop_a_run(spark, tmp_path):
    """A first increment without products, digits of other scripts, and totals beyond 64 bits."""
    layers, log = layered.Layers(str(tmp_path / "lake")), runlog.RunLog(spark, str(tmp_path / "log"))
    source = str(tmp_path / "in")
    _send(spark, source, [_record("536000", "POST", 1)])
    layered.run_increment(spark, source, layers, log)
    assert sinks.read_snapshot(spark, layers.path("silver")).count() == 0
    odd = [_record("\u0665\u0663\u0666\u0660\u0660", "10001", 1), _record("536001", "10001", 1, price="inf")]
    odd += [_record("536002", "10001", 9 * 10**18), _record("536002", "10001", 9 * 10**18, price="3.00")]
    _send(spark, source, odd + [_record("536003", "10001", 2)], 100)
    layered.run_increment(spark, source, layers, log)
    invoices = _rows(sinks.read_snapshot(spark, layers.path("silver")), "InvoiceNo")
    assert invoices == [("536003",), ("\u0665\u0663\u0666\u0660\u0660",)]
    aside = spark.read.parquet(layers.path("non_product"))
    assert _rows(aside, "InvoiceNo") == [("536000",), ("536001",), ("536002",), ("536002",)]
    gates = spark.read.parquet(layers.path("gates"))
    assert gates.filter("success").count() == gates.count() == 2 * 5


def test_a_refused_increment_is_not_in_the_audit_table(spark, tmp_path, monkeypatch):
    layers, log = layered.Layers(str(tmp_path / "lake")), runlog.RunLog(spark, str(tmp_path / "log"))
    monkeypatch.setattr(layered, "BRONZE_SUITE", quality.Suite("none", (quality.matches_regex("InvoiceNo", "^x$"),)))
    _send(spark, str(tmp_path / "in"), [_record("536000", "10001", 1)])
    with pytest.raises(quality.QualityGateError):
        layered.run_increment(spark, str(tmp_path / "in"), layers, log)
    assert not (tmp_path / "lake" / "bronze").exists()
    assert spark.read.parquet(layers.path("gates")).first()["unexpected_count"] == 1


def test_increments_go_through_all_layers(spark, tmp_path):
    layers, log = layered.Layers(str(tmp_path / "lake")), runlog.RunLog(spark, str(tmp_path / "log"), "manual__1")
    source = str(tmp_path / "in")
    _send(spark, source, BATCH_A)
    counts = layered.run_increment(spark, source, layers, log).first()
    assert (counts["target_rows_inserted"], counts["target_rows_updated"]) == (50, 0)
    fixed = [_record(f"{536000 + i}", f"{10000 + i % 7}", 2 * (i + 1)) for i in range(20)]
    _send(spark, source, fixed + [_record("537000", "10003", 9)], 1000)
    counts = layered.run_increment(spark, source, layers, log).first()
    assert tuple(counts) == (20, 1, 21, 30)
    assert layered.run_increment(spark, source, layers, log).count() == 0
    assert spark.read.parquet(layers.path("bronze")).count() == 51 + 21
    gold = sinks.read_snapshot(spark, layers.path("gold"))
    total = sum(2 * (i + 1) for i in range(20)) + sum(i + 1 for i in range(20, 50)) + 9
    assert gold.agg(F.sum("total_quantity")).first()[0] == total
    assert sinks.read_snapshot(spark, layers.path("chunks")).count() > gold.count()
    summary = runlog.run_summary(log.events())
    assert {r["state"] for r in summary.collect()} == {"COMPLETE"}
    assert {r["run_id"] for r in summary.collect()} == {runlog.run_id("manual__1")}


def test_failed_gate_keeps_the_old_table_and_stops_the_run(spark, tmp_path, monkeypatch):
    layers, log = layered.Layers(str(tmp_path / "lake")), runlog.RunLog(spark, str(tmp_path / "log"))
    source = str(tmp_path / "in")
    _send(spark, source, BATCH_A)
    layered.run_increment(spark, source, layers, log)
    before = _rows(sinks.read_snapshot(spark, layers.path("silver")), "InvoiceNo", "Quantity")
    real = layered.silver_increment

    def damaged(records):
        grain, others = real(records)
        return grain.withColumn("invoice_ts", F.lit(None).cast("timestamp")), others

    monkeypatch.setattr(layered, "silver_increment", damaged)
    _send(spark, source, [_record("536000", "10000", 99)], 1000)
    with pytest.raises(quality.QualityGateError, match="invoice_ts"):
        layered.run_increment(spark, source, layers, log)
    assert _rows(sinks.read_snapshot(spark, layers.path("silver")), "InvoiceNo", "Quantity") == before
    states = {(r["job"], r["state"]) for r in runlog.run_summary(log.events()).collect()}
    assert ("silver", "FAIL") in states
    gold_events = log.events().filter("job = 'gold'").count()
    assert gold_events == 2  # START and COMPLETE of the first run only
    monkeypatch.undo()
    counts = layered.run_increment(spark, source, layers, log).collect()  # the refused increment is taken up again
    assert [tuple(c) for c in counts] == [(1, 0, 1, 49)]
    assert spark.read.parquet(layers.path("bronze")).count() == 52


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "t")
    assert sinks.read_snapshot(spark, root) is None
    sinks.publish_snapshot(spark.range(3), root)

    def refuse(_):
        raise quality.QualityGateError("no")

    with pytest.raises(quality.QualityGateError):
        sinks.publish_snapshot(spark.range(5), root, refuse)
    assert sinks.read_snapshot(spark, root).count() == 3
    sinks.publish_snapshot(sinks.read_snapshot(spark, root).union(spark.range(1)), root)
    assert sinks.read_snapshot(spark, root).count() == 4
    for n in range(5):
        sinks.publish_snapshot(spark.range(n), root)
    assert len(sinks.published_versions(spark, root)) == sinks.KEPT_VERSIONS
    assert sinks.publish_snapshot(spark.range(0), root).count() == sinks.read_snapshot(spark, root).count() == 0


def test_run_log_states(spark, tmp_path):
    log = runlog.RunLog(spark, str(tmp_path / "log"))
    with log.stage("good"):
        pass
    with pytest.raises(SystemExit), log.stage("bad"):
        raise SystemExit(1)
    rows = {r["job"]: r for r in runlog.run_summary(log.events()).collect()}
    assert (rows["good"]["state"], rows["bad"]["state"]) == ("COMPLETE", "FAIL")
    assert all(r["events"] == 2 and r["duration_us"] >= 0 for r in rows.values())


def test_run_ids():
    fixed = str(uuid.uuid4())
    assert runlog.run_id(fixed) == fixed
    assert runlog.run_id("manual__2026") == str(uuid.uuid5(uuid.NAMESPACE_URL, "manual__2026"))
    assert runlog.run_id() != runlog.run_id()


def test_csv_strings(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('InvoiceNo,StockCode\n2,"a ""b"""\n1,\n')
    df = files.scan_csv_strings(spark, str(path), ["InvoiceNo", "StockCode"])
    assert _rows(df, "InvoiceNo", "StockCode") == [("1", ""), ("2", 'a "b"')]
    first = files.scan_csv_strings(spark, str(path), ["InvoiceNo", "StockCode"], [F.col("InvoiceNo")], 1)
    assert _rows(first, "InvoiceNo") == [("1",)]
    with pytest.raises(ValueError):
        files.scan_csv_strings(spark, str(path), limit=1)


def test_documents_skip_blank_lines(spark, tmp_path):
    path = tmp_path / "docs.jsonl"
    path.write_text('{"doc_id": "1", "title": "t", "text": "x"}\n\n   \n{"doc_id": "2", "text": "y"}\n')
    assert _rows(files.scan_documents(spark, str(path)), "doc_id", "title", "text") == [("1", "t", "x"), ("2", None, "y")]


def test_empty_landing_files_have_columns(spark, tmp_path):
    (tmp_path / "empty.jsonl").write_text("")
    grain, others = silver_increment(files.scan_landing(spark, str(tmp_path)))
    assert grain.count() == others.count() == 0


def test_append_checks_the_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    empty = spark.createDataFrame([], SILVER)
    sinks.append_table(empty, path, SILVER)
    with pytest.raises(sinks.conform.__globals__["SchemaMismatchError"]):
        sinks.append_table(empty.withColumn("discount", F.lit(1.0)), path, SILVER)
    assert "ingest_ts" in append_audit(empty).columns


def test_json_payload_keeps_nulls(spark):
    df = topics.to_json_payload(spark.createDataFrame([("x", None)], "a string, b string"))
    assert json.loads(df.first()["payload"]) == {"a": "x", "b": None}


def test_size_checks(spark):
    assert is_small(spark.range(10), 10)
    assert not is_small(spark.range(11), 10)
    assert not is_small(spark.range(10).select(F.lit("x" * 100).alias("t")), 100, 500)
    assert is_small(spark.range(0))
    stored = materialize(spark.range(5), "test")
    assert stored.count() == 5 and spread(stored).rdd.getNumPartitions() >= 4
