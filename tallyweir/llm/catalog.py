"""The registered queries of the training-data operators, one per operator, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweir.llm import (
    bpe_tree,
    cotraining,
    divergence,
    license_digests,
    line_spread,
    mixing,
    outliers,
    piece_counts,
    prefix_trie,
    simhash,
    spaced_seeds,
    transcripts,
    url_rules,
)
from tallyweir.llm.oracles import LINE_SPREAD, SPACED_SEEDS
from tallyweir.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer file is installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_table(spark, sf_dir, "documents"))


def op2_transcript_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = transcripts.raw_transcripts(_table(spark, sf_dir, "conversations"))
    return transcripts.recovered_turns(lines, fit_on=~transcripts.held_out(F.col("conv_id")))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_pages(_table(spark, sf_dir, "pages"))


def op6_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_tree_encoding(docs: DataFrame) -> DataFrame:
    return bpe_tree.encoding_digests(docs, tokenizer_path("byte_bpe_50k.json"))


def op8_piece_counts(docs: DataFrame) -> DataFrame:
    return piece_counts.token_counts(docs, tokenizer_path("piece_bpe_32k.model"))


def op10_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spaced_seeds.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(_table(spark, sf_dir, "conversations"))


_QUERIES: dict[str, Query] = {
    "op1_robust_outliers": _documents(outliers.quality_verdicts),
    "op2_transcript_roles": op2_transcript_roles,
    "op3_simhash_planes": _documents(simhash.simhash_components),
    "op4_url_rules": op4_url_rules,
    "op5_line_spread": _documents(
        lambda docs: line_spread.remove_boilerplate(docs).select("doc_id", "n_lines", "n_removed", "text")
    ),
    "op6_co_training": op6_co_training,
    "op7_tree_encoding": _documents(op7_tree_encoding),
    "op8_piece_counts": _documents(op8_piece_counts),
    "op9_license_digests": _documents(license_digests.scan_licenses),
    "op10_spaced_seeds": op10_spaced_seeds,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_source_divergence": _documents(divergence.source_divergence),
    "op13_block_mix": _documents(mixing.mix_report),
}


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {name: _shipped(query) for name, query in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {
        "op4_url_rules": url_rules.ORACLE_SQL,
        "op5_line_spread": LINE_SPREAD,
        "op9_license_digests": license_digests.oracle_sql(),
        "op10_spaced_seeds": SPACED_SEEDS,
        "op11_prefix_trie": prefix_trie.ORACLE_SQL,
        "op12_source_divergence": divergence.ORACLE_SQL,
    }
