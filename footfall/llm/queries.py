"""Registered queries of the corpus operators: thin digests over the operators' own outputs."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from footfall.llm import (
    audit, binary, decontaminate, lines, oracles, packing, phrases, quality, sharding, simhash, tokens, toxicity, warc, wrappers,
)
from footfall.llm.common import read_table
from footfall.session import new_path

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return simhash.near_duplicates(docs, shingle=3, max_bits=3).select("doc_id", "fingerprint", "component_id")


def warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.round_trip(read_table(spark, sf_dir, "pages"))
    return rows.select(
        warc.page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_of(F.col("refers_to")).alias("refers_to"),
    )


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.ledger(read_table(spark, sf_dir, "documents"))
    rows = quality.apply_policy(rows, quality.CURRENT).withColumn("base_failed", quality.rejected(quality.BASE))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "failed",
    )


def shortest_pack_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer())


def hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.curve_shards(read_table(spark, sf_dir, "documents"), 40)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tokens.token_counts(read_table(spark, sf_dir, "documents"), tokenizer())
    return rows.withColumn("over_limit", F.col("n_tokens") > 512)


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines.dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return rows.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(read_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).select("doc_id", "held_out", "score", "predicted")


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document and item found in it."""
    docs, benchmark = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    found = decontaminate.contaminated(docs, benchmark, short_inside=True)
    return found.select("doc_id", "item_id", "similarity", "start", "bits")


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "token-files")
    binary.write(read_table(spark, sf_dir, "documents"), tokenizer(), folder)
    return binary.read_documents(spark, folder)


def filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_simhash_near_dedup": simhash_near_dedup,
    "op2_warc_round_trip": warc_round_trip,
    "op3_quality_rules": quality_rules,
    "op4_shortest_pack_first": shortest_pack_first,
    "op5_hilbert_shards": hilbert_shards,
    "op6_token_counts": token_counts,
    "op7_line_dedup": line_dedup,
    "op8_html_extraction": html_extraction,
    "op9_toxicity_grammar": toxicity_grammar,
    "op10_benchmark_decontamination": benchmark_decontamination,
    "op11_token_files": token_files,
    "op12_filter_interaction_audit": filter_interaction_audit,
    "op13_phrase_collocations": phrase_collocations,
}

ORACLE_SQL: dict[str, str] = {
    "op3_quality_rules": oracles.QUALITY,
    "op7_line_dedup": oracles.LINES,
    "op12_filter_interaction_audit": oracles.AUDIT,
    "op13_phrase_collocations": oracles.COLLOCATIONS,
}
