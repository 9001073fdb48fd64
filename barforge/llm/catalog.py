"""Registered queries of the operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barforge.llm import (
    decontaminate, filter_audit, imatch, langid, lines, order_minhash, packing, quality, secrets, sharding, suffixes,
    token_alignment, wavelet,
)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_groups(_documents(spark, sf_dir), whole=False).select("doc_id", "class_id", "group_id")


def op2_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return quality.score_documents(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.find_leaks(_documents(spark, sf_dir), benchmark)


def op4_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return langid.identify(docs, langid.fit(docs))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), _tokenizer("word_bpe_49k.json"))


def op6_line_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_classes(_documents(spark, sf_dir)).drop("tsig")


def op7_sparse_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.report(suffixes.repeated_spans(_documents(spark, sf_dir)))


def op8_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.compare_edited(_documents(spark, sf_dir))


def op9_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.token_files(_documents(spark, sf_dir), _tokenizer("byte_bpe_50k.json"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.find_secrets(_documents(spark, sf_dir)))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.report(_documents(spark, sf_dir))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.report(
        _documents(spark, sf_dir), _tokenizer("byte_bpe_50k.json"), _tokenizer("piece_bpe_32k.model"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_order_minhash, op2_pu_quality, op3_decontaminate, op4_ppm_language, op5_packing, op6_line_join,
        op7_sparse_suffixes, op8_imatch, op9_wavelet_tokens, op10_secrets, op11_filter_audit, op12_sharding, op13_token_alignment,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op6_line_join": lines.oracle(), "op8_imatch": imatch.oracle(), "op10_secrets": secrets.oracle(),
        "op11_filter_audit": filter_audit.oracle(),
    }
