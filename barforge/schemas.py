"""Declared schemas of every layer (never inferred)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MASTER = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("company_name", T.StringType()),
])

LANDING = T.StructType([
    T.StructField("Date", T.TimestampType()),
    T.StructField("Open", T.DoubleType()),
    T.StructField("High", T.DoubleType()),
    T.StructField("Low", T.DoubleType()),
    T.StructField("Close", T.DoubleType()),
    T.StructField("Volume", T.DoubleType()),
    T.StructField("Dividends", T.DoubleType()),
    T.StructField("Stock Splits", T.DoubleType()),
    T.StructField("Symbol", T.StringType()),
])

BRONZE = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
    T.StructField("dividends", T.DoubleType()),
    T.StructField("stock_splits", T.DoubleType()),
    T.StructField("symbol", T.StringType()),
])

CONTROL = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("last_extract_date", T.DateType()),
    T.StructField("rows_extracted", T.LongType()),
    T.StructField("last_run_id", T.StringType()),
    T.StructField("last_run_timestamp", T.TimestampNTZType()),
    T.StructField("last_run_type", T.StringType()),
    T.StructField("last_status", T.StringType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

BARS = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
])

GOLD = T.StructType(BARS.fields + [
    T.StructField("sma_30", T.DoubleType()),
    T.StructField("cci_34", T.DoubleType()),
    T.StructField("rs_nifty50", T.DoubleType()),
    T.StructField("rs_nifty500", T.DoubleType()),
    T.StructField("is_breakout_13w", T.IntegerType()),
    T.StructField("is_breakout_26w", T.IntegerType()),
    T.StructField("is_breakout_52w", T.IntegerType()),
    T.StructField("is_breakout_104w", T.IntegerType()),
])

STAGING_COLUMNS = ["date", "symbol", "open", "high", "low", "close", "volume",
                   "dividends", "stock_splits"]
BAR_COLUMNS = ["date", "symbol", "open", "high", "low", "close", "volume"]
GOLD_COLUMNS = BAR_COLUMNS + [
    "sma_30", "cci_34", "rs_nifty50", "rs_nifty500",
    "is_breakout_13w", "is_breakout_26w", "is_breakout_52w", "is_breakout_104w",
]

# Fixed values of the reference pipeline.
RUN_TYPES = ("FULL", "DELTA")
STATUSES = ("SUCCESS", "FAILED")
CLASSES = ("NEW", "DELTA", "UP_TO_DATE")
BENCHMARK_SYMBOLS = ("NIFTY50", "NIFTY500")
SYMBOL_SUFFIX = ".NS"
LOOKBACK_MONTHS = 60  # the "5y" full-load period


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: cast each declared column, add absent
    ones as typed NULLs, drop undeclared ones (schema-on-read, as an external
    table with typed columns does)."""
    present = set(df.columns)
    return df.select([
        (F.col(f"`{f.name}`").cast(f.dataType) if f.name in present
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


def assert_schema(df: DataFrame, schema: T.StructType, layer: str) -> DataFrame:
    """Fail fast if a layer drifts from its declared names and types."""
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in schema.fields]
    if got != want:
        raise ValueError(f"schema drift in layer {layer!r}: {got} != {want}")
    return df
