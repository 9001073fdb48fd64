"""The change set: which symbols changed since which date, per load.

A load adds its rows (symbol, since) as a partition of its own before it
publishes bronze; a transform reads all loads, and drops those it has read
once its tables are published. A crash in between leaves the loads, so the
next transform covers them; a load added meanwhile is another partition and
stays."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.sources import storage


@dataclass
class ChangeSet:
    symbols: DataFrame   # symbol, since: one row per changed symbol
    loads: list[str]


def record_changes(spark: SparkSession, path: str, rows: DataFrame, load: str) -> None:
    """Add what a load is about to change: the earliest date of every symbol."""
    since = (rows.where(F.col("date").isNotNull() & F.col("symbol").isNotNull())
                 .groupBy("symbol").agg(F.min("date").alias("since")))
    load = re.sub(r"[^\w-]", "_", load) + f"-{uuid.uuid4().hex[:8]}"   # the same run may load twice
    version = storage.write_version(since, path, {"load": F.lit(load)}, ("symbol",), [(load,)])
    if version.values:
        storage.publish(spark, version)


def read_changes(spark: SparkSession, path: str) -> ChangeSet:
    """All recorded loads; the loads' names are one per run since the last transform."""
    if not storage.is_published(spark, path):
        return ChangeSet(spark.createDataFrame([], "symbol string, since date"), [])
    name = storage.table_name(spark, path)
    loads = sorted(r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect())
    rows = spark.table(name).where(F.col("load").isin(*loads) if loads else F.lit(False))
    return ChangeSet(storage.materialise(rows.groupBy("symbol").agg(F.min("since").alias("since"))), loads)


def clear_changes(spark: SparkSession, path: str, loads: list[str]) -> None:
    """Drop the loads that a finished transform has read."""
    if loads:
        parts = ", ".join(f"PARTITION (load='{x}')" for x in loads)
        spark.sql(f"ALTER TABLE {storage.table_name(spark, path)} DROP IF EXISTS {parts}")
