"""Queries of the training-data operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from metricspark.llm import (
    byte_bpe,
    decontam,
    filter_audit,
    html_text,
    langid,
    license_scan,
    mixing,
    near_dup,
    oracles,
    phrases,
    quality,
    sharding,
    token_counts,
    token_files,
)
from metricspark.llm.tokens import public_tokenizer


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all documents takes from each (see :func:`mixing.mix_sources` for odd rows)."""
    return mixing.taken_words(mixing.mix_sources(_table(spark, sf_dir, "documents")))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page (see :func:`html_text.main_text` for odd rows)."""
    return html_text.main_text(_table(spark, sf_dir, "pages"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of every document's ids, read back from written token files (see :func:`token_files.write_token_files`)."""
    written = token_files.write_token_files(_table(spark, sf_dir, "documents"), public_tokenizer("word_bpe_49k.json"))
    return token_files.read_digests(written)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items (see :func:`decontam.contaminated` for odd rows)."""
    hits = decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return decontam.contaminated_documents(hits)


def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document (see :func:`near_dup.near_duplicates` for odd rows)."""
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document (see :func:`license_scan.scan_licenses` for odd rows)."""
    return license_scan.scan_licenses(_table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-balanced shard and slot of every document (see :func:`sharding.shard_by_bytes` for odd rows)."""
    return sharding.shard_by_bytes(_table(spark, sf_dir, "documents"), shards=24)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements and verdict of every document (see :func:`quality.ledger` for odd rows)."""
    rows = quality.apply_policy(quality.ledger(_table(spark, sf_dir, "documents")), version=2)
    measures = [m for m in quality.MEASURES if m != "n_lines"]
    base_failed = (rows.fail_bits.bitwiseAND(quality.BASE) != 0).alias("base_failed")
    return rows.select("doc_id", *measures, base_failed, "kept", "fail_bits")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document (see :func:`langid.identify` for odd rows)."""
    return langid.identify_documents(_table(spark, sf_dir, "documents"))


def language_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page, with markup, address suffix and host as evidence (see :func:`langid.identify`)."""
    return langid.identify_pages(_table(spark, sf_dir, "pages"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-length histogram of all documents with suffix sums (see :func:`token_counts.length_histogram`)."""
    histogram = token_counts.length_histogram(_table(spark, sf_dir, "documents"), public_tokenizer("word_bpe_49k.json"))
    return token_counts.with_suffix_sums(histogram)


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best phrases of each language over all documents (see :func:`phrases.collocations` for odd rows)."""
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order of the five filters over all documents, per source (see :func:`filter_audit.audit` for odd rows)."""
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the bytes they decode to (see :func:`byte_bpe.encode` for odd rows)."""
    stated = byte_bpe.vocabulary()
    return byte_bpe.digests(byte_bpe.decode(byte_bpe.encode(_table(spark, sf_dir, "documents"), stated), stated))


def token_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus size truncated to common context limits, from the histogram of all documents."""
    return token_counts.truncated_totals(op10_token_counts(spark, sf_dir), [512, 1024, 2048, 4096, 8192])


def token_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of the encoded lengths, from the histogram of all documents."""
    return token_counts.quantiles(op10_token_counts(spark, sf_dir), [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0])


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the policy costs over all documents."""
    return quality.ablations(quality.ledger(_table(spark, sf_dir, "documents")), version=2)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mix_sources": op1_mix_sources,
        "op2_html_text": op2_html_text,
        "op3_token_files": op3_token_files,
        "op4_decontamination": op4_decontamination,
        "op5_near_dup": op5_near_dup,
        "op6_license_scan": op6_license_scan,
        "op7_sharding": op7_sharding,
        "op8_quality_rules": op8_quality_rules,
        "op9_language_id": op9_language_id,
        "op10_token_counts": op10_token_counts,
        "op11_phrases": op11_phrases,
        "op12_filter_audit": op12_filter_audit,
        "op13_byte_bpe": op13_byte_bpe,
        "language_of_pages": language_of_pages,
        "token_limits": token_limits,
        "token_quantiles": token_quantiles,
        "quality_ablations": quality_ablations,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_near_dup": oracles.NEAR_DUP,
        "op6_license_scan": oracles.license_sql(),
        "op8_quality_rules": oracles.quality_sql(version=2),
        "op11_phrases": oracles.phrases_sql(),
        "op12_filter_audit": oracles.audit_sql(),
        "quality_ablations": oracles.ablations_sql(version=2),
    }
