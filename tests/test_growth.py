"""What is stored, shuffled and read again must not grow faster than the input, nor be stored twice."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyweir import session
from tallyweir.operators import contract, lists, medallion, quality, runlog
from tallyweir.operators.vector import vector_topk
from tallyweir.plans import catalog, inputs, layered
from tallyweir.schemas import LANDING
from tallyweir.sources import files, sinks
from tallyweir.streaming.ingest import ingest_stream, merge_stream, message_stream

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")


@needs_tables
def test_messages_and_results_are_stored_compressed_and_once(spark, tmp_path):
    messages, root = inputs.raw_messages(spark, SF_DIR), str(tmp_path)
    sinks.write_messages(messages, f"{root}/in")
    ingest_stream(message_stream(spark, f"{root}/in"), f"{root}/landing", f"{root}/dead", f"{root}/ck").awaitTermination()
    for folder in ("in", "landing", "dead"):
        parts = list((tmp_path / folder).rglob("part-*"))
        assert parts and all(p.name.endswith(".json.gz") for p in parts)
    assert files.read_messages(spark, f"{root}/in").count() == messages.count()
    judged = contract.needed_parts(contract.apply_contract(messages, contract.RETAIL_TRANSACTION))
    accepted = judged.filter("status = 'accepted'")
    assert accepted.filter("payload IS NOT NULL OR raw IS NOT NULL").isEmpty() and not accepted.filter("record IS NOT NULL").isEmpty()
    assert judged.filter("status = 'rejected' AND record IS NOT NULL").isEmpty()


@needs_tables
def test_customers_are_joined_to_orders_not_to_lines(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = inputs.retail_lines(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    at = next(i for i, line in enumerate(plan) if "hashpartitioning(o_custkey" in line)
    depth = plan[at].index("Exchange")
    below = [line for line in plan[at + 1 :] if line[:depth + 1].strip(" :|") == ""]
    assert below and not any("l_linenumber" in line for line in below)


def test_moments_are_those_of_the_pattern(spark):
    from tallyweir.functions.retail import parse_invoice_date

    texts = ["2/29/2012 23:59", "2/29/2011 0:00", "12/31/9999 24:00", "4/30/2010 8:60", "13/1/2010 1:00", " 4/30/2010 \t 08:9 ", "1/1/0000 0:00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    spaced = F.trim(F.regexp_replace("t", r"\s+", " "))
    wanted = F.try_to_timestamp(spaced, F.lit("M/d/yyyy H:m"))
    assert df.filter(~parse_invoice_date(F.col("t")).eqNullSafe(wanted)).isEmpty()


@needs_tables
def test_lists_are_no_literals_of_the_plan_and_pairs_no_rows(spark):
    """Centroids grow with the vectors; a plan that holds them, or a row per pair, grows faster than the input."""
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    asked = vectors.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    index = lists.build_lists(vectors, ["vec_id"], n_lists=40)
    found = lists.lists_topk(index, asked, 5, probes=2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "zip_with" not in plan and "lambda" not in plan and "Join" not in plan and len(plan) < 20_000
    exact = vector_topk(vectors, asked, ["vec_id"], 5)
    rows = [sorted((r["query_id"], r["rank"], r["vec_id"], round(r["distance"], 6)) for r in t.collect()) for t in (found, exact)]
    assert rows[0] == rows[1]


@pytest.mark.parametrize("limits", [(50_000, 1 << 26, 50_000), (1, 1, 1)], ids=["broadcast", "grid"])
def test_lists_with_many_copies_far_from_the_origin(spark, limits):
    import numpy as np

    rng = np.random.default_rng(3)
    data = 1e4 + rng.normal(size=(400, 6))
    data[50:200] = data[0]
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id int, embedding array<double>")
    asked = vectors.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    index = lists.build_lists(vectors, ["vec_id"], n_lists=30)
    found = lists.lists_topk(index, asked, 7, probes=3, query_limits=limits).orderBy("query_id", "rank").collect()
    for q in range(0, 400, 20):
        distance = np.round(((data - data[q]) ** 2).sum(axis=1), 9)
        wanted = sorted(range(400), key=lambda i: (distance[i], i))[:7]
        assert [r["vec_id"] for r in found if r["query_id"] == q] == wanted


def test_terms_are_counted_within_their_chunk(spark):
    """Postings need no shuffle, a document's figures one; the sorted tokens are made once per chunk, not once per token."""
    from collections import Counter

    from tallyweir.operators import bm25

    tokens = [["x", "b", "x", "B", "x"], [], ["q"], ["é", "e", "é"] * 50]
    chunks = spark.createDataFrame([("d", i, t) for i, t in enumerate(tokens)], "doc_id string, pos int, tokens array<string>")
    found = bm25.Bm25Index(chunks, chunks, 4, 0, 0.0).postings()
    wanted = sorted((i, term, tf, len(t)) for i, t in enumerate(tokens) for term, tf in Counter(t).items())
    assert sorted((r["pos"], r["term"], r["tf"], r["length"]) for r in found.collect()) == wanted
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("sort_array") == 1


def test_stored_search_in_many_cells_returns_few_pairs(spark, tmp_path, monkeypatch):
    """A word of every chunk makes no row per question and chunk, and postings are made without a shuffle."""
    from tallyweir.operators import bm25, postings

    words = [" ".join(["all"] + [f"w{(i * j) % 37}" for j in range(1, 9)]) for i in range(900)]
    chunks = spark.createDataFrame([(f"d{i}_0", f"d{i}", 0, t) for i, t in enumerate(words)], "chunk_id string, doc_id string, pos int, text string")
    asked = spark.createDataFrame([(q, f"all w{q} w{(q * 3) % 37} w5") for q in range(12)], "query_id long, text string")
    monkeypatch.setattr(postings, "CELL_ROWS", 200)
    monkeypatch.setattr(postings, "CELL_QUERIES", 3)
    index = postings.publish_index(chunks, str(tmp_path), block_chunks=50, buckets=4)
    stored, real = {}, postings.materialize
    monkeypatch.setattr(postings, "materialize", lambda df, label: stored.update({label: real(df, label)}) or stored[label])
    found = postings.stored_topk(index, asked, 5).select("query_id", "rank", "doc_id", F.round("score", 6).alias("s")).collect()
    wanted = bm25.bm25_topk(bm25.bm25_index(chunks), asked, 5).select("query_id", "rank", "doc_id", F.round("score", 6).alias("s")).collect()
    assert sorted(found) == sorted(wanted)
    assert stored["best-scores"].count() <= 12 * 900 / 10
    rows = postings._rows(bm25.bm25_index(chunks), 50, 4)
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("sample", [20_000, 300, 3])
def test_slices_rank_the_rows_near_a_cut_only(spark, monkeypatch, sample):
    """Every cut is exact, with ties, copies and NULLs, whatever was sampled; rows far from a cut are not ranked."""
    from tallyweir.operators import changes

    values = [(None if i % 11 == 0 else f"k{(i * 7919) % 700:03d}", str(i % 5)) for i in range(5000)]
    df = spark.createDataFrame(values, "a string, b string").repartition(4)
    ordered = sorted(values, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    cuts = {"first": (0, 3571), "corrected": (0, 1428), "added": (3571, 5000), "near": (1400, 1430), "nulls": (0, 100), "none": (7, 7), "all": (0, 5000)}
    ranked, real = [], changes.global_rank
    monkeypatch.setattr(changes, "global_rank", lambda d, *a, **k: ranked.append(d.count()) or real(d, *a, **k))
    monkeypatch.setattr(changes, "SLICE_SAMPLE", sample)
    for chosen in (cuts, {n: cuts[n] for n in ("first", "corrected", "added")}):
        found = changes.row_slices(df, [F.asc("a"), F.asc("b")], chosen, "a")
        for name, (low, high) in chosen.items():
            assert sorted(map(tuple, found[name].collect()), key=repr) == sorted(ordered[low:high], key=repr), name
    if sample == 20_000:
        assert ranked[-1] < 1500
    tied = spark.createDataFrame([("x", str(i)) for i in range(60)], "a string, b string")
    half = changes.row_slices(tied, [F.asc("a"), F.asc("b")], {"half": (0, 30)}, "a")["half"]
    assert sorted(r["b"] for r in half.collect()) == sorted(str(i) for i in range(60))[:30]


@needs_tables
def test_rolled_up_sides_are_merged_without_a_shuffle_of_their_own(spark):
    """One full join of two grains: each is dealt out by its keys once, below its roll-up, and read once."""
    from tallyweir.operators import medallion, merge
    from tallyweir.schemas import GRAIN_KEYS

    lines = inputs.retail_lines(spark, SF_DIR)
    sides = [medallion.silver_grain(lines.filter(t).localCheckpoint()) for t in ("Quantity < 30", "Quantity > 10")]
    stored = [medallion.silver_increment(lines.filter(t))[0] for t in ("Quantity < 30", "Quantity > 10")]
    merged = merge.merge_tagged(*sides, GRAIN_KEYS, unique=True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 2 and plan.count("Join") == 1
    expected = merge.merge_tagged(*stored, GRAIN_KEYS)
    assert merged.exceptAll(expected).isEmpty() and expected.exceptAll(merged).isEmpty()
    assert merge.merge_metrics(merged).first() == merge.merge_metrics(expected, stored[1]).first()
    keyless = spark.createDataFrame([(None, "1", 1), ("a", "1", 2)], "k1 string, k2 string, v int")
    assert merge.merge_metrics(merge.merge_tagged(keyless, keyless, ["k1", "k2"], unique=True)).first() == (1, 1, 2, 1)


@needs_tables
def test_gates_store_only_the_columns_they_read(spark, monkeypatch):
    """The bronze gate neither judges messages nor stores texts that no expectation names; results are those of the whole tables."""
    from tallyweir.operators import medallion, quality
    from tallyweir.plans import catalog

    stored, real = {}, catalog.materialize
    monkeypatch.setattr(catalog, "materialize", lambda df, label: stored.update({label: real(df, label)}) or stored[label])
    bronze, silver = catalog._bronze_results(spark, SF_DIR), catalog._injected_results(spark, SF_DIR)
    assert stored["messages"].columns == ["InvoiceNo", "StockCode"]
    assert stored["silver"].columns == ["InvoiceNo", "StockCode", "invoice_ts", "_injected"]
    whole = contract.apply_contract(inputs.raw_messages(spark, SF_DIR), contract.RETAIL_TRANSACTION).select("raw.*")
    assert bronze.collect() == quality.run_expectations(whole, quality.BRONZE_SUITE).collect()
    grain, _ = medallion.silver_increment(inputs.retail_lines(spark, SF_DIR))
    injected = catalog.changes.inject_duplicates(grain, 5, ["InvoiceNo", "StockCode"])
    assert silver.collect() == quality.run_expectations(injected, quality.SILVER_SUITE).collect()


def test_a_payload_is_worked_out_before_it_is_parsed(spark):
    """Beneath the parsing its expression would be interpreted for every row."""
    made = spark.range(3).select(F.concat(F.lit('{"InvoiceNo": "'), (F.col("id") + 536365).cast("string"), F.lit('"}')).alias("payload"))
    texts = contract.raw_texts(made, contract.RETAIL_TRANSACTION, ["InvoiceNo"])
    parsing = [line for line in texts._jdf.queryExecution().optimizedPlan().toString().splitlines() if "from_json" in line]
    assert parsing and not any("536365" in line for line in parsing)
    odd = spark.createDataFrame([(None,), ("",), ("[1]",), ('{"InvoiceNo": 5} x',), ('{"InvoiceNo": 5}',)], "payload string")
    assert [r[0] for r in contract.raw_texts(odd, contract.RETAIL_TRANSACTION, ["InvoiceNo"]).collect()] == [None, None, None, None, "5"]


def _landed(spark, path, first, last, quantity):
    """One landed line per invoice and two that are set aside, in plain JSON."""
    codes = [(i, f"{10000 + i % 7}", quantity) for i in range(first, last)] + [(first, "POST", 1), (first, "19999", 2**62)]
    rows = [(f"{536000 + i}", code, f"ITEM {code}", q, "12/1/2010 8:26", 2.0, "1", "France", i, 0) for i, code, q in codes]
    rows.append((*rows[-1][:2], "again", *rows[-1][3:]))
    spark.createDataFrame(rows, LANDING).write.mode("append").json(path)


def _files(root, *but):
    return sorted(p.name for p in Path(root).rglob("*") if p.is_file() and not any(b in str(p) for b in but))


@pytest.fixture
def shuffle_files(spark):
    """Whether shuffles since the start of the test still have files, once the cleaner had time for them; one may, as a
    stage that turned out not to be needed can end after its query."""
    local = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    numbers = lambda: {n.split("_")[1] for d in local for n in _files(d) if n.startswith("shuffle_")}
    before = numbers()

    def left():
        for _ in range(50):
            if len(numbers() - before) < 2:
                return False
            time.sleep(0.1)
        return True

    return left


def test_merging_in_passes_stores_and_shuffles_a_part_at_a_time(spark, tmp_path, monkeypatch, shuffle_files):
    """The same table, counts and rows set aside as in one pass, and nothing that only the merge needed is left."""
    monkeypatch.setattr(session, "MOST_PASSES", 3)
    scratch, found, merged_rows = tmp_path / "scratch", {}, []
    monkeypatch.setattr(session, "shared_root", lambda spark: str(scratch))
    real = sinks._tagged

    def watched(target, source, keys):
        merged_rows.append((0 if target is None else target.count(), source.count()))
        return real(target, source, keys)

    monkeypatch.setattr(sinks, "_tagged", watched)
    for rows in (1000, 10):
        monkeypatch.setattr(session, "PASS_ROWS", rows)
        root = str(tmp_path / str(rows))
        for day, (first, last) in enumerate(((0, 60), (30, 90))):
            _landed(spark, f"{root}/landing{day}", first, last, day + 1)
            stream = spark.readStream.schema(LANDING).json(f"{root}/landing{day}")
            merge_stream(stream, f"{root}/silver", f"{root}/side", f"{root}/checkpoint{day}", f"day{day}").awaitTermination()
        assert not _files(scratch) and not shuffle_files()
        silver = sinks.read_snapshot(spark, f"{root}/silver")
        aside = spark.read.parquet(f"{root}/side/aside")
        actions = spark.read.parquet(sinks.latest_snapshot(spark, f"{root}/silver")[1]).groupBy("_action").count()
        with session.released_shuffles(spark):
            found[rows] = [sorted(map(str, df.collect())) for df in (silver, aside, actions)]
        assert len(merged_rows) == (2 if rows == 1000 else 6)
        assert sum(s for _, s in merged_rows) == 120 and sum(t for t, _ in merged_rows) == 60
        assert max(s for _, s in merged_rows) < 60 or rows == 1000
        merged_rows.clear()
    assert found[1000] == found[10] and len(found[10][0]) == 90 and len(found[10][1]) == 6


def test_key_passes_part_the_rows(spark, tmp_path, monkeypatch):
    rows = [(k, n) for k in ("a", "b", None, "c", "d") for n in range(6)]
    df = spark.createDataFrame(rows, "k string, n int")
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert len(session.key_passes(stored, ["k"])) == 1
    monkeypatch.setattr(session, "PASS_ROWS", 7)
    parts = [stored.filter(part).collect() for part in session.key_passes(stored, ["k"])]
    assert len(parts) == 5 and sorted(map(str, (tuple(r) for part in parts for r in part))) == sorted(map(str, rows))
    assert all(len([1 for part in parts if any(r.k == k for r in part)]) == 1 for k in ("a", "b", None, "c", "d"))


def test_lines_are_not_shuffled_again_for_a_few_that_do_not_fit(spark, tmp_path):
    _landed(spark, str(tmp_path / "in"), 0, 60, 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _, others = medallion.silver_increment(files.scan_landing(spark, str(tmp_path / "in")))
        plan = others._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan and others.count() == 3


@needs_tables
def test_landed_records_are_stored_compressed_and_shuffles_released(spark, tmp_path, monkeypatch, shuffle_files):
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, label: str(tmp_path / label))
    silver = catalog.stream_merge(spark, SF_DIR)
    parts = list((tmp_path / "stream_merge" / "landing").rglob("part-*"))
    assert parts and all(p.name.endswith(".json.gz") for p in parts) and not shuffle_files()
    assert silver.count() > 0


def test_layers_in_passes_keep_only_their_tables(spark, tmp_path, monkeypatch, shuffle_files):
    """Every layer as in one pass; of an increment nothing is left but the layers."""
    monkeypatch.setattr(session, "MOST_PASSES", 3)
    monkeypatch.setattr(session, "shared_root", lambda spark: str(tmp_path / "scratch"))
    names, found = ("InvoiceNo", "StockCode", "Quantity"), []
    text = '{{"InvoiceNo": "{}", "StockCode": "{}", "Quantity": {}, "InvoiceDate": "12/1/2010 8:26", "UnitPrice": 2, "Country": "France"}}'
    lines = [(536000 + i // 2, f"{10000 + i % 7}", i) for i in range(40)]
    lines += [(536000, "POST", 1), (1, "10001", 1), *((537000, "10001", 2**62 + i) for i in range(2))]
    rows = [(text.format(*line), i, 0) for i, line in enumerate(lines)]
    for pass_rows in (1000, 10):
        monkeypatch.setattr(session, "PASS_ROWS", pass_rows)
        layers = layered.Layers(str(tmp_path / f"lake{pass_rows}"))
        messages = spark.createDataFrame(rows, "payload string, source_offset long, source_partition int")
        sinks.write_messages(messages, f"{layers.root}-in")
        counts = layered.run_increment(spark, f"{layers.root}-in", layers, runlog.RunLog(spark, f"{layers.root}-log"))
        assert not _files(tmp_path / "scratch") and not shuffle_files()
        tables = [sinks.read_snapshot(spark, layers.path(t)) for t in ("silver", "gold", "chunks")]
        tables += [counts, *(spark.read.parquet(layers.path(t)) for t in ("non_product", "gates")), spark.read.parquet(layers.path("bronze")).select(*names)]
        with session.released_shuffles(spark):
            found.append([sorted(map(str, t.collect())) for t in tables])
    assert found[0] == found[1] and [len(t) for t in found[0]] == [40, 7, 49, 1, 3, 5, 43]


def test_repeated_keys_are_found_in_passes(spark, tmp_path, monkeypatch):
    rows = [(f"{i % 9}" if i % 9 else None, f"{i % 2}" if i % 5 else None) for i in range(60)]
    stored = session.materialize(spark.createDataFrame(rows, "a string, b string"), "keys")
    suite = quality.Suite("keys", (quality.not_null("a"), quality.unique_keys("a", "b"), quality.matches_regex("b", "1")))
    whole = quality.run_expectations(stored, suite).collect()
    monkeypatch.setattr(session, "PASS_ROWS", 10)
    assert len(session.key_passes(stored, ["a", "b"])) == 6
    assert sorted(map(str, quality.run_expectations(stored, suite).collect())) == sorted(map(str, whole))
