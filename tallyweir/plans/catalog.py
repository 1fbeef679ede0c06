"""The registered queries: every operator over the given tables, as (session, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweir.functions.retail import format_invoice_date
from tallyweir.functions.vectors import embed, hashing_embedder
from tallyweir.operators import bm25, changes, contract, documents, hashed, lists, medallion, merge, postings, quality, retrieval, runlog
from tallyweir.operators.rank import global_rank
from tallyweir.operators.vector import vector_topk
from tallyweir.plans import inputs
from tallyweir.plans.layered import Layers, run_increment
from tallyweir.schemas import BUSINESS_COLUMNS, GRAIN_KEYS, LANDING, SILVER
from tallyweir.session import materialize, released_shuffles, scratch_path, ship_package
from tallyweir.sources import files, keyed, sinks, topics
from tallyweir.streaming.ingest import ingest_stream, message_stream, merge_stream

Query = Callable[[SparkSession, str], DataFrame]


def _moment(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def _six(column: str) -> Column:
    """Six decimals, for values that two engines may add up in different orders."""
    return (F.floor(F.col(column) * 1e6 + 0.5) / 1e6).alias(column)


# Tables of the layers


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    grain, _ = medallion.silver_increment(inputs.retail_lines(spark, sf_dir))
    return grain


def _stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)  # a filter over a table that silver_increment has stored


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.rank_products(_stored_silver(spark, sf_dir))


def _shown_silver(silver: DataFrame) -> DataFrame:
    return silver.select(
        "InvoiceNo",
        "StockCode",
        "Quantity",
        F.col("line_revenue").cast("double").alias("line_revenue"),
        _moment("invoice_ts").alias("invoice_ts"),
        "Description",
        "CustomerID",
        "Country",
        "is_cancellation",
        _six("UnitPrice"),
        "_injected",
    )


# Sources and sinks


def scan_csv_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    inputs.text_lines(inputs.retail_lines(spark, sf_dir)).write.option("header", True).csv(path)
    return files.scan_csv_strings(spark, path)


def format_invoice_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders")
    minutes = F.make_dt_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))
    return orders.select("o_orderkey", format_invoice_date(F.col("o_orderdate") + minutes).alias("invoice_date"))


def to_json_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = inputs.text_lines(inputs.retail_lines(spark, sf_dir))
    return topics.to_json_payload(texts, BUSINESS_COLUMNS).select("payload")


def bronze_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "bronze")
    lines = inputs.retail_lines(spark, sf_dir)
    even = F.col("line_id") % 2 == 0
    for increment in (lines.filter(even), lines.filter(~even)):
        sinks.append_table(medallion.append_audit(increment.select(*BUSINESS_COLUMNS)), path)
    stored = files.scan_table(spark, path)
    return stored.select(
        *BUSINESS_COLUMNS[:5],
        F.col("UnitPrice").cast("double").alias("UnitPrice"),
        *BUSINESS_COLUMNS[6:],
        F.col("ingest_ts").isNotNull().alias("stamped"),
    )


def docs_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "docs")
    sinks.write_documents(inputs.documents(spark, sf_dir), path)
    return files.scan_documents(spark, path)


def schema_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per country after two appends: one with an undeclared column, refused, and one that
    leaves a column out, which is filled with NULL."""
    path = scratch_path(spark, "guarded")
    silver = _stored_silver(spark, sf_dir)
    fitting = silver.drop("CustomerID")
    refused = "nothing"
    try:
        sinks.append_table(fitting.withColumn("discount", F.lit(99.9)), path, SILVER)
    except merge.SchemaMismatchError as error:
        refused = str(error)
    sinks.append_table(fitting, path, SILVER)
    return (
        files.scan_table(spark, path)
        .groupBy("Country")
        .agg(F.count(F.lit(1)).alias("rows_written"), F.count("CustomerID").alias("customers"))
        .withColumn("refused", F.lit(refused))
    )


# Contract and streaming


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.apply_contract(inputs.raw_messages(spark, sf_dir), contract.RETAIL_TRANSACTION)


def _shown_rejects(rejects: DataFrame) -> DataFrame:
    return rejects.select(
        *[F.col(f"rejected_record.{c}").alias(f"raw_{c}") for c in BUSINESS_COLUMNS],
        "payload",
        "rejection_reason",
        F.array_join("failed_fields", ",").alias("failed_fields"),
        "source_offset",
        "source_partition",
    )


def contract_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.accepted_records(_checked(spark, sf_dir))


def contract_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_rejects(contract.rejected_records(_checked(spark, sf_dir)))


def contract_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.contract_summary(_checked(spark, sf_dir))


def _ingest(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    root = scratch_path(spark, "ingest")
    sinks.write_messages(inputs.raw_messages(spark, sf_dir), f"{root}/messages")
    ingest_stream(
        message_stream(spark, f"{root}/messages"), f"{root}/landing", f"{root}/dead_letters", f"{root}/checkpoint"
    ).awaitTermination()
    return f"{root}/landing", f"{root}/dead_letters"


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.scan_landing(spark, _ingest(spark, sf_dir)[0]).drop("batch_id")


def dlq_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_rejects(files.read_rejects(spark, _ingest(spark, sf_dir)[1]))


def landing_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "landing")
    contract_valid(spark, sf_dir).write.json(path)
    return files.scan_landing(spark, [path])


def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver table after landed records were folded into it as a stream."""
    root = scratch_path(spark, "stream_merge")
    with released_shuffles(spark):
        sinks.write_json_lines(contract_valid(spark, sf_dir), f"{root}/landing")
    stream = spark.readStream.schema(LANDING).json(f"{root}/landing")
    merge_stream(stream, f"{root}/silver", f"{root}/non_product", f"{root}/checkpoint").awaitTermination()
    return _shown_silver(sinks.read_snapshot(spark, f"{root}/silver"))


def layered_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product table after one increment went through all layers and gates."""
    root = scratch_path(spark, "layered")
    with released_shuffles(spark):
        sinks.write_messages(inputs.raw_messages(spark, sf_dir), f"{root}/messages")
    layers = Layers(f"{root}/lake")
    run_increment(spark, f"{root}/messages", layers, runlog.RunLog(spark, f"{root}/events"))
    return sinks.read_snapshot(spark, layers.path("gold"))


# Tabular core


def dedup_business_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.retail_lines(spark, sf_dir)
    doubled = lines.unionByName(lines.filter("Quantity < 0"))
    return medallion.dedup_rows(doubled).withColumn("UnitPrice", F.col("UnitPrice").cast("double"))


def route_non_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, others = medallion.route_products(inputs.retail_lines(spark, sf_dir))
    return others.select("line_id", "InvoiceNo", "StockCode", "Description", "Quantity", "Country")


def flag_cancellation(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = medallion.flag_cancellations(inputs.retail_lines(spark, sf_dir))
    return flagged.select("line_id", "InvoiceNo", "StockCode", "Quantity", "is_cancellation")


def silver_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_silver(_silver(spark, sf_dir))


def top3_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.top_countries(medallion.sellable(_silver(spark, sf_dir)))


def gold_product_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir)


def gold_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _gold(spark, sf_dir)
        .select("revenue_rank", "StockCode", "Description", "total_revenue", "num_invoices", "top_countries")
        .orderBy("revenue_rank")
        .limit(5)
    )


def global_rank_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return global_rank(
        orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], output="price_rank", total="total_orders"
    )


# Increments, merge, delete


def _batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Texts of (first load, correction batch): 5/7 of all lines; 2/7 corrected and the other 2/7."""
    # stored, as they are read for the cuts and for each slice
    texts = materialize(inputs.text_lines(inputs.retail_lines(spark, sf_dir)), "texts")
    total = inputs.table(spark, sf_dir, "lineitem").count()
    order = [F.asc(c) for c in BUSINESS_COLUMNS]
    slices = changes.row_slices(
        texts,
        order,
        {
            "first": (0, total * 5 // 7),
            "corrected": (0, total * 2 // 7),
            "added": (total * 5 // 7, total),
        },
        BUSINESS_COLUMNS[0],
    )
    return slices["first"], changes.correction_batch(slices["corrected"], slices["added"])


def correction_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batches(spark, sf_dir)[1]


def _merge_sides(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Grain rows of the first load and of the correction batch, each with unique keys; not stored, as a merge reads them once."""
    return [medallion.silver_grain(inputs.typed_lines(batch)) for batch in _batches(spark, sf_dir)]


def silver_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _merge_sides(spark, sf_dir)
    return _shown_silver(merge.merge_tagged(target, source, GRAIN_KEYS, unique=True).drop(merge.ACTION))


def bucket_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge into a stored table in hash buckets by invoice."""
    target, source = _merge_sides(spark, sf_dir)
    table = keyed.create_keyed(spark, scratch_path(spark, "keyed"), target.schema, GRAIN_KEYS, GRAIN_KEYS[:1])
    table.upsert(target)
    table.upsert(source)
    return _shown_silver(table.read())


def merge_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _merge_sides(spark, sf_dir)
    return merge.merge_metrics(merge.merge_tagged(target, source, GRAIN_KEYS, unique=True))


def _injected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.inject_duplicates(_stored_silver(spark, sf_dir), 5, GRAIN_KEYS)


def inject_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_silver(_injected(spark, sf_dir))


def predicate_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_silver(merge.delete_where(_injected(spark, sf_dir), F.col("_injected")))


def delete_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.delete_counts(_injected(spark, sf_dir), F.col("_injected"))


# Gates and run log


def _shown_results(results: DataFrame) -> DataFrame:
    counts = F.transform(
        "partial_unexpected_counts",
        lambda e: F.concat(F.coalesce(e["value"], F.lit("null")), F.lit("="), e["count"].cast("string")),
    )
    return results.select(
        "suite",
        "position",
        "expectation_type",
        "column_list",
        "success",
        "element_count",
        "unexpected_count",
        _six("unexpected_percent"),
        F.coalesce("missing_count", F.lit(-1)).alias("missing_count"),  # -1: not applicable
        *[
            F.coalesce(_six(c), F.lit(-1.0)).alias(c)
            for c in ("missing_percent", "unexpected_percent_total", "unexpected_percent_nonmissing")
        ],
        F.array_join("partial_unexpected_list", "|", "null").alias("partial_unexpected_list"),
        F.array_join(counts, "|").alias("partial_unexpected_counts"),
    )


def _bronze_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = inputs.raw_messages(spark, sf_dir)
    texts = contract.raw_texts(messages, contract.RETAIL_TRANSACTION, quality.BRONZE_SUITE.columns)
    return quality.run_expectations(materialize(texts, "messages"), quality.BRONZE_SUITE)


def gate_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_results(_bronze_results(spark, sf_dir))


def _judged_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All grain rows, stored with the columns that the gate reads."""
    grain = medallion.silver_grain(inputs.retail_lines(spark, sf_dir))
    return materialize(grain.select(*quality.SILVER_SUITE.columns, "_injected"), "silver")


def _injected_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    injected = changes.inject_duplicates(_judged_silver(spark, sf_dir), 5, GRAIN_KEYS)
    return quality.run_expectations(injected, quality.SILVER_SUITE)


def gate_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_results(quality.run_expectations(_judged_silver(spark, sf_dir), quality.SILVER_SUITE))


def gate_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_results(_injected_results(spark, sf_dir))


def gate_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = _bronze_results(spark, sf_dir).unionByName(_injected_results(spark, sf_dir))
    return quality.verdict(results).withColumn("success_percent", _six("success_percent"))


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    micro = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return runlog.run_summary(inputs.stage_events(spark, sf_dir)).select(
        "run_id",
        "job",
        F.date_format("started_at", micro).alias("started_at"),
        F.date_format("ended_at", micro).alias("ended_at"),
        "state",
        "events",
        "duration_us",
    )


# Documents and retrieval


def product_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.product_documents(_gold(spark, sf_dir))


def chunk_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.chunk_sentences(inputs.documents(spark, sf_dir))


def chunks_per_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.chunks_per_document(chunk_sentences(spark, sf_dir))


def bm25_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every term of the text collection with its document frequency and weight."""
    index = bm25.bm25_index(chunk_sentences(spark, sf_dir))
    return index.terms.select("term", "df", _six("idf"))


def bm25_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks, tokens, distinct terms and term occurrences of each document, from the postings."""
    postings = bm25.postings_of(bm25.chunk_tokens(chunk_sentences(spark, sf_dir)))
    return postings.groupBy("doc_id").agg(
        F.countDistinct("pos").alias("chunks"),
        F.count(F.lit(1)).alias("postings"),
        F.sum("tf").alias("tokens"),
    )


def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = bm25.bm25_index(materialize(chunk_sentences(spark, sf_dir), "chunks"))
    hits = bm25.bm25_topk(index, inputs.benchmark_questions(spark, sf_dir), retrieval.SEARCH_DEPTH)
    return hits.select("query_id", "rank", "chunk_id", "doc_id", "pos", _six("score"))


def bm25_stored_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same hits from a published index: postings by term, blocks left out by their bounds."""
    index = postings.publish_index(chunk_sentences(spark, sf_dir), scratch_path(spark, "index"))
    hits = postings.stored_topk(index, inputs.benchmark_questions(spark, sf_dir), retrieval.SEARCH_DEPTH)
    return hits.select("query_id", "rank", "chunk_id", "doc_id", "pos", _six("score"))


def vector_topk_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors nearest to the mean vector of each label."""
    vectors = inputs.table(spark, sf_dir, "embeddings")
    entries = vectors.select("label", F.posexplode("embedding").alias("dim", "value"))
    means = entries.groupBy("label", "dim").agg(F.avg(F.col("value").cast("double")).alias("mean"))
    centroids = means.groupBy(F.col("label").alias("query_id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("dim", "mean"))), lambda e: e["mean"]).alias("embedding")
    )
    hits = vector_topk(vectors, centroids, ["vec_id"], retrieval.SEARCH_DEPTH)
    return hits.select("query_id", "rank", "vec_id", _six("distance"))


def vector_lists_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors nearest to every vector whose id is divisible by 20, by inverted lists."""
    vectors = inputs.table(spark, sf_dir, "embeddings")
    asked = vectors.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    hits = lists.lists_topk(lists.build_lists(vectors, ["vec_id"]), asked, retrieval.SEARCH_DEPTH)
    return hits.select("query_id", "rank", "vec_id", _six("distance"))


def vector_hashed_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors nearest to every vector whose id is divisible by 20, by stored hash buckets: nine in ten of them or more."""
    vectors = inputs.table(spark, sf_dir, "embeddings")
    asked = vectors.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    index = hashed.publish_hashed(vectors, ["vec_id"], scratch_path(spark, "hashed"), retrieval.SEARCH_DEPTH)
    hits = hashed.hashed_topk(index, asked, retrieval.SEARCH_DEPTH)
    return hits.select("query_id", "rank", "vec_id", _six("distance"))


def expand_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions = inputs.catalog_questions(spark, sf_dir).unionByName(inputs.benchmark_questions(spark, sf_dir))
    return retrieval.expand_query(questions)


def _document_retrieval(spark: SparkSession, sf_dir: str) -> tuple[retrieval.Retrieval, DataFrame]:
    questions = inputs.benchmark_questions(spark, sf_dir)
    index = retrieval.build_index(chunk_sentences(spark, sf_dir))
    return retrieval.retrieve(index, questions), questions


def embed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vector of every chunk, as its non-zero places and their sum of squares."""
    vectors = embed(chunk_sentences(spark, sf_dir), "text", hashing_embedder())
    places = F.transform("embedding", lambda v, i: F.when(v != 0, F.concat(i.cast("string"), F.when(v > 0, "+").otherwise("-"))))
    return vectors.select(
        "chunk_id",
        F.array_join(F.filter(places, lambda p: p.isNotNull()), " ").alias("places"),
        F.aggregate("embedding", F.lit(0.0), lambda total, v: total + v * v).alias("squares"),
    ).select("chunk_id", "places", _six("squares"))


def rrf_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = _document_retrieval(spark, sf_dir)
    return found.fused.select(
        "query_id",
        "rank",
        "chunk_id",
        F.coalesce("first_rank", F.lit(-1)).alias("vector_rank"),  # -1: not in that list
        F.coalesce("second_rank", F.lit(-1)).alias("bm25_rank"),
        F.round("score", 9).alias("score"),
    )


def rerank_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = _document_retrieval(spark, sf_dir)
    return found.reranked.select("query_id", "rank", "chunk_id", "fused_rank", _six("pair_score"))


def retrieval_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = _document_retrieval(spark, sf_dir)
    return retrieval.retrieval_compare(
        {"bm25": found.bm25, "vector": found.vector, "rrf": found.fused, "rerank": found.reranked}
    )


def compose_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, questions = _document_retrieval(spark, sf_dir)
    return retrieval.compose_answer(found.reranked, questions).select("query_id", "question", "answer", "report")


def catalog_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cited answers from the product catalog to a question per product name and nation."""
    docs = documents.product_documents(_gold(spark, sf_dir))
    index = retrieval.build_index(documents.chunk_sentences(docs))
    answers = retrieval.answer_questions(index, inputs.catalog_questions(spark, sf_dir))
    return answers.select("query_id", "question", "answer", "report")


def queries() -> dict[str, Query]:
    named = {
        "scan_csv_strings": scan_csv_strings,
        "format_invoice_date": format_invoice_dates,
        "to_json_payload": to_json_payload,
        "bronze_append": bronze_append,
        "docs_scan": docs_scan,
        "schema_diff": schema_guard,
        "contract_valid": contract_valid,
        "contract_rejects": contract_rejects,
        "contract_summary": contract_summary,
        "stream_ingest": stream_ingest,
        "dlq_read": dlq_read,
        "landing_scan": landing_scan,
        "stream_merge": stream_merge,
        "layered_run": layered_run,
        "dedup_business_cols": dedup_business_cols,
        "route_non_product": route_non_product,
        "flag_cancellation": flag_cancellation,
        "silver_grain": silver_grain,
        "top3_countries": top3_countries,
        "gold_product_ranking": gold_product_ranking,
        "gold_top5": gold_top5,
        "global_rank": global_rank_orders,
        "correction_batch": correction_batch,
        "silver_merge": silver_merge,
        "bucket_merge": bucket_merge,
        "merge_metrics": merge_metrics,
        "inject_duplicates": inject_duplicates,
        "predicate_delete": predicate_delete,
        "delete_counts": delete_counts,
        "gate_bronze": gate_bronze,
        "gate_silver": gate_silver,
        "gate_results": gate_results,
        "gate_verdict": gate_verdict,
        "run_summary": run_summary,
        "product_documents": product_documents,
        "chunk_sentences": chunk_sentences,
        "chunks_per_doc": chunks_per_doc,
        "bm25_index": bm25_index,
        "bm25_lengths": bm25_lengths,
        "bm25_topk": bm25_topk,
        "bm25_stored_topk": bm25_stored_topk,
        "vector_topk": vector_topk_query,
        "vector_lists_topk": vector_lists_topk,
        "vector_hashed_topk": vector_hashed_topk,
        "expand_query": expand_query,
        "embed_chunks": embed_chunks,
        "rrf_fusion": rrf_fusion,
        "rerank_topk": rerank_topk,
        "retrieval_compare": retrieval_compare,
        "compose_answer": compose_answer,
        "catalog_answers": catalog_answers,
    }
    return {name: _shipped(query) for name, query in named.items()}


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    run.__doc__ = query.__doc__
    return run
