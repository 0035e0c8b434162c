"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parcelog.llm import decontaminate, edit_counts, frames, licenses, merkle, packing, perplexity, quality, resampling, secrets, simhash, suffix_dedup, warc


def _tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, _table(spark, sf_dir, "documents"), _tokenizer())


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.rules(_table(spark, sf_dir, "documents"), words=True)


def op4_edit_aware_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_counts.masked_counts(_table(spark, sf_dir, "documents"), _tokenizer())


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(_table(spark, sf_dir, "documents"), licenses.TEMPLATES + licenses.MORE_TEMPLATES, windows=True)


def op6_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.token_files(spark, _table(spark, sf_dir, "documents"), _tokenizer())


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(spark, _table(spark, sf_dir, "pages"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(suffix_dedup.deduplicate(_table(spark, sf_dir, "documents")))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_manifest(_table(spark, sf_dir, "documents"))


_REGISTERED = (
    op1_best_fit_packing,
    op2_secret_scan,
    op3_quality_rules,
    op4_edit_aware_counts,
    op5_license_scan,
    op6_token_id_files,
    op7_benchmark_decontamination,
    op8_simhash_components,
    op9_quality_classifier,
    op10_warc_archives,
    op11_suffix_dedup,
    op12_importance_resampling,
    op13_merkle_manifest,
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _REGISTERED}
ORACLE_SQL: dict[str, str] = {}
