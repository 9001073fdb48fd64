"""Corpus pipeline: quality, line dedup, near dedup, decontamination, packing.

``STAGES`` lists (name, function) in order; a function takes
(spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's documents.  All stages but the last return the
columns of the documents.  A stage works on whatever the one before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barforge.llm import decontaminate, lines, order_minhash, packing, quality
from barforge.llm.common import scratch_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand in an earlier document, or nearly so, go."""
    return lines.drop_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return order_minhash.drop_near(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces of everything that is left."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", keep_good),
    ("lines", drop_repeated_lines),
    ("near", drop_near_copies),
    ("benchmark", drop_benchmark),
    ("packing", pack_sequences),
]

#: The stages fit a classifier and tokenize: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = scratch_path(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{root}/{k}-{name}"
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
