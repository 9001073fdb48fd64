"""Landing price files -> bronze rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.functions import nan_to_null, to_trading_day
from barforge.schemas import BRONZE, LANDING, conform

# Landing -> bronze column names, and the keep-list order.
RENAMES = {
    "Date": "date", "Open": "open", "High": "high", "Low": "low",
    "Close": "close", "Volume": "volume", "Dividends": "dividends",
    "Stock Splits": "stock_splits", "Symbol": "symbol",
}
KEEP = ["date", "open", "high", "low", "close", "volume",
        "dividends", "stock_splits", "symbol"]
DOUBLE_COLUMNS = ("open", "high", "low", "close", "dividends", "stock_splits")


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """Raw landing parquet files with the declared landing schema."""
    return spark.read.schema(LANDING).parquet(path)


def normalize_landing(landing: DataFrame, exchange_tz: str | Column,
                      strict_volume: bool = True) -> DataFrame:
    """Rename to snake case, take the exchange-local trading day, cast
    volume to bigint, turn NaN into NULL, keep the known columns in a fixed
    order (absent ones skipped). ``exchange_tz`` names the zone in which a
    bar's day is counted, or is a column that names it row by row
    (``with_exchange_zone``).

    Volume: fractions truncate; a NaN raises, and a NULL volume raises too
    when ``strict_volume`` (an integer cast fails on a missing value)."""
    df = landing.withColumnsRenamed({k: v for k, v in RENAMES.items() if k in landing.columns})
    session_tz = df.sparkSession.conf.get("spark.sql.session.timeZone")
    cols = {}
    if "date" in df.columns:
        cols["date"] = to_trading_day("date", df.schema["date"].dataType, exchange_tz, session_tz)
    if "volume" in df.columns:
        v = F.col("volume")
        cast = F.when(F.isnan(v.cast("double")), F.raise_error(F.lit("NaN volume in landing data")).cast("bigint")).otherwise(
            v.cast("bigint"))
        if strict_volume:
            cast = F.when(v.isNull(), F.raise_error(F.lit("NULL volume in landing data")).cast("bigint")).otherwise(cast)
        cols["volume"] = cast
    for c in DOUBLE_COLUMNS:
        if c in df.columns:
            cols[c] = nan_to_null(F.col(c).cast("double"))
    df = df.withColumns(cols)
    return df.select(*[c for c in KEEP if c in df.columns])


#: The column of the master list that names a symbol's exchange zone.
ZONE = "exchange_tz"


def with_exchange_zone(landing: DataFrame, master: DataFrame, column: str = ZONE) -> DataFrame:
    """Landing rows with the zone of their symbol's exchange from the master
    list (P4 by row), for ``normalize_landing(rows, F.col(column))``. A symbol
    listed twice has one zone, the first in order; rows of symbols without a
    zone are an error when their day is taken, not a silent UTC day. The list
    has one row per symbol, so AQE broadcasts it only at a measured size."""
    zones = master.groupBy(F.col("symbol").alias("Symbol")).agg(F.min(column).alias(column))
    named = landing.join(zones, "Symbol", "left")
    missing = F.raise_error(F.concat(F.lit("no exchange zone for symbol "), F.coalesce("Symbol", F.lit("NULL"))))
    return named.withColumn(column, F.coalesce(F.col(column), missing.cast("string")))


def to_bronze(df: DataFrame) -> DataFrame:
    """Tolerant projection completed: absent columns as typed NULLs."""
    return conform(df, BRONZE)


def read_bronze(spark: SparkSession, path: str, since=None) -> DataFrame:
    """The bronze table read with its declared types (S4). Partition columns
    of the storage layout are dropped. ``since`` keeps rows dated on or
    after it, pruning whole partitions of a date-partitioned layout."""
    from barforge.sources.storage import partition_floor, read_table

    df = read_table(spark, path)
    if since is not None:
        floor = partition_floor(df.columns, since)
        if floor is not None:
            df = df.where(floor)
        df = df.where(F.col("date") >= F.lit(since))
    return conform(df, BRONZE)


def table_stats(df: DataFrame) -> DataFrame:
    """Rows, distinct symbols and date range of a price table in one pass
    (S9)."""
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  F.count_distinct("symbol").alias("symbol_count"),
                  F.min("date").alias("min_date"),
                  F.max("date").alias("max_date"))


def file_count(spark: SparkSession, path: str) -> int:
    """Number of data files behind a stored table (S9), from its listing."""
    from barforge.sources.storage import read_table

    return len(set(read_table(spark, path).inputFiles()))


def footer_stats(spark: SparkSession, path: str) -> DataFrame:
    """Rows and date range of a stored table from its Parquet footers alone
    (S9): the aggregate is pushed into the scan, no data page is read. The
    pushdown needs the DSv2 reader, so it runs in a session of its own."""
    from barforge.sources.storage import read_table

    files = sorted(set(read_table(spark, path).inputFiles()))
    meta = spark.newSession()
    meta.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    meta.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    rows = meta.read.parquet(*files) if files else meta.createDataFrame([], BRONZE)
    return rows.agg(F.count(F.lit(1)).alias("row_count"), F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def stored_stats(spark: SparkSession, path: str) -> DataFrame:
    """Statistics of a stored table, one row (S9): files from the listing,
    rows and date range from the footers, symbols from that column alone."""
    from barforge.sources.storage import read_table

    seen = footer_stats(spark, path).first()
    return read_table(spark, path).agg(F.count_distinct("symbol").alias("symbol_count")).select(
        F.lit(file_count(spark, path)).cast("bigint").alias("file_count"),
        F.lit(seen["row_count"]).cast("bigint").alias("row_count"), "symbol_count",
        F.lit(seen["min_date"]).cast("date").alias("min_date"), F.lit(seen["max_date"]).cast("date").alias("max_date"))


__all__ = ["KEEP", "RENAMES", "file_count", "footer_stats", "normalize_landing", "read_bronze",
           "read_landing", "stored_stats", "table_stats", "to_bronze", "with_exchange_zone"]
