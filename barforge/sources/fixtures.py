"""Price fixtures derived from ``lineitem`` and ``supplier``.

The driver's tables hold no prices, so every input of the pipeline is
derived here with plain DataFrame expressions (one supplier = one symbol,
one line item = one trade). Everything scales with the given tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.functions import utc_midnight, wall_clock
from barforge.schemas import BRONZE, CONTROL, MASTER, conform

# Fixed values of the incremental-load fixture.
# After every trade of the given tables, so the run date cuts nothing.
RUN_DATE = dt.date(2001, 12, 31)
RUN_TS = dt.datetime(2001, 12, 31, 12, 0, 0)
RUN_ID = "testrun1"
SEED_DATE = dt.date(2000, 1, 1)
SEED_TS = dt.datetime(2000, 1, 1, 0, 0, 0)
UPSERT_TARGET_BEFORE = dt.date(2000, 6, 1)
UPSERT_SOURCE_FROM = dt.date(2000, 1, 1)
INDEX_NAMES = ("NIFTY50", "NIFTY500")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _symbol(k: Column) -> Column:
    return F.concat(F.lit("S"), k.cast("string"))


def trades(spark: SparkSession, sf_dir: str, with_key: bool = False) -> DataFrame:
    """One daily price row per line item, in the bronze schema."""
    li = table(spark, sf_dir, "lineitem")
    open_ = F.col("l_extendedprice") / F.col("l_quantity")
    base = li.select(
        F.col("l_suppkey").alias("k"),
        F.col("l_shipdate").cast("date").alias("date"),
        open_.alias("open"),
        (open_ * (F.lit(1.0) + F.col("l_tax") - F.col("l_discount"))).alias("close"),
        F.col("l_quantity").cast("bigint").alias("volume"),
    )
    out = base.select(
        "k", "date", "open",
        (F.greatest("open", "close") * F.lit(1.01)).alias("high"),
        (F.least("open", "close") * F.lit(0.99)).alias("low"),
        "close", "volume",
        F.lit(0.0).alias("dividends"), F.lit(0.0).alias("stock_splits"),
        _symbol(F.col("k")).alias("symbol"),
    )
    cols = [f.name for f in BRONZE.fields]
    return out.select(*(["k"] + cols if with_key else cols))


def index_rows(spark: SparkSession, sf_dir: str, names=INDEX_NAMES) -> DataFrame:
    """Daily benchmark rows: quantity-weighted price over all suppliers
    (second name) and over suppliers with ``k % 10 = 0`` (first name).
    Sums run over integer cents, so the value does not depend on order.
    Both indices come from one aggregation pass over ``lineitem``."""
    li = table(spark, sf_dir, "lineitem")
    cents = F.round(F.col("l_extendedprice") * F.lit(100)).cast("bigint")
    qty = F.col("l_quantity").cast("bigint")
    narrow_member = F.col("l_suppkey") % 10 == 0
    agg = (li.groupBy(F.col("l_shipdate").cast("date").alias("date"))
             .agg(F.sum(F.when(narrow_member, cents)).alias("c_narrow"),
                  F.sum(F.when(narrow_member, qty)).alias("q_narrow"),
                  F.count_if(narrow_member).alias("n_narrow"),
                  F.sum(cents).alias("c_broad"), F.sum(qty).alias("q_broad")))
    narrow, broad = names
    rows = agg.select("date", F.inline(F.array(
        F.struct(F.lit(narrow).alias("symbol"), F.col("c_narrow").alias("c"),
                 F.col("q_narrow").alias("volume"), (F.col("n_narrow") > 0).alias("present")),
        F.struct(F.lit(broad).alias("symbol"), F.col("c_broad").alias("c"),
                 F.col("q_broad").alias("volume"), F.lit(True).alias("present")))))
    price = (F.col("c") / F.lit(100.0)) / F.col("volume")
    return rows.where("present").select(
        "date", price.alias("open"), price.alias("high"), price.alias("low"),
        price.alias("close"), "volume", F.lit(0.0).alias("dividends"),
        F.lit(0.0).alias("stock_splits"), "symbol")


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze fixture for staging, silver and gold: trades plus indices."""
    return conform(trades(spark, sf_dir).unionByName(index_rows(spark, sf_dir)), BRONZE)


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = table(spark, sf_dir, "supplier")
    return conform(sup.select(_symbol(F.col("s_suppkey")).alias("symbol"),
                              F.col("s_name").alias("company_name")), MASTER)


def control(spark: SparkSession, sf_dir: str, run_date: dt.date = RUN_DATE) -> DataFrame:
    """Seed control table: no row for ``k % 4 = 0``; watermark at run_date
    for ``k % 4 = 1``, else 2000-01-01 minus ``k % 7`` days; FAILED for
    ``k % 4 = 3``."""
    k = F.col("s_suppkey")
    sup = table(spark, sf_dir, "supplier").where(k % 4 != 0)
    wm = F.when(k % 4 == 1, F.lit(run_date)).otherwise(
        F.date_sub(F.lit(SEED_DATE), (k % 7).cast("int")))
    return conform(sup.select(
        _symbol(k).alias("symbol"),
        wm.alias("last_extract_date"),
        F.lit(0).cast("bigint").alias("rows_extracted"),
        F.lit("seed").alias("last_run_id"),
        wall_clock(SEED_TS).alias("last_run_timestamp"),
        F.lit("FULL").alias("last_run_type"),
        F.when(k % 4 == 3, F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("last_status"),
        wall_clock(SEED_TS).alias("updated_at"),
    ), CONTROL)


def _to_landing(df: DataFrame) -> DataFrame:
    return df.select(
        utc_midnight("date").alias("Date"),
        F.col("open").alias("Open"), F.col("high").alias("High"),
        F.col("low").alias("Low"), F.col("close").alias("Close"),
        F.col("volume").cast("double").alias("Volume"),
        F.col("dividends").alias("Dividends"),
        F.col("stock_splits").alias("Stock Splits"),
        F.col("symbol").alias("Symbol"),
    )


def landing(spark: SparkSession, sf_dir: str, late: bool = False) -> DataFrame:
    """Raw landing rows of the first attempt; symbols with ``k % 5 = 2`` only
    arrive late (``late=True``), so the first pass fails on them, and those
    with ``k % 10 = 7`` among them never arrive."""
    t = trades(spark, sf_dir, with_key=True)
    k = F.col("k")
    return _to_landing(t.where((k % 5 == 2) & (k % 10 != 7) if late else k % 5 != 2))


def landing_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trade as a raw landing row."""
    return _to_landing(trades(spark, sf_dir))


def upsert_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(target, source) for the upsert: deduplicated trades before
    2000-06-01, and from 2000-01-01 on with volume + 1."""
    from barforge.operators.staging import stage_daily

    stg = stage_daily(conform(trades(spark, sf_dir), BRONZE)).select(*[f.name for f in BRONZE.fields])
    target = stg.where(F.col("date") < F.lit(UPSERT_TARGET_BEFORE))
    source = (stg.where(F.col("date") >= F.lit(UPSERT_SOURCE_FROM))
                 .withColumn("volume", F.col("volume") + 1))
    return target, source


def landing_with_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trade as a landing row, where a feed glitch left NaN closes: every first of the
    month for symbols with ``k % 7 = 3``."""
    t = trades(spark, sf_dir, with_key=True)
    glitch = (F.col("k") % 7 == 3) & (F.dayofmonth("date") == 1)
    t = t.withColumn("close", F.when(glitch, F.lit(float("nan"))).otherwise(F.col("close")))
    return _to_landing(t)


def constituents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A constituents list as published (header names verbatim); a third of
    the symbols carries stray spaces, a third a tab and a CRLF."""
    k = F.col("s_suppkey")
    sym = F.concat(F.lit("S"), k.cast("string"))
    return table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("Company Name"),
        F.col("s_nationkey").cast("string").alias("Industry"),
        F.when(k % 3 == 0, F.concat(F.lit(" "), sym, F.lit(" ")))
         .when(k % 3 == 1, F.concat(F.lit("\t"), sym, F.lit("\r\n"))).otherwise(sym).alias("Symbol"),
    )


ZONES = ("Asia/Kolkata", "America/New_York")


def master_with_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The master list with each symbol's exchange zone: the first for even ``k``, the second for odd."""
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        _symbol(k).alias("symbol"), F.col("s_name").alias("company_name"),
        F.when(k % 2 == 0, F.lit(ZONES[0])).otherwise(F.lit(ZONES[1])).alias("exchange_tz"))


def landing_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trade as a landing row at half past hour ``(5 k + volume) % 24``
    UTC, so days turn in both zones and on both sides of a clock change;
    volumes have fractions, dividends and splits are not zero."""
    t = trades(spark, sf_dir, with_key=True)
    k, volume = F.col("k"), F.col("volume")
    seconds = F.unix_date("date") * 86400 + ((k * 5 + volume) % 24) * 3600 + 1800
    return t.select(
        F.timestamp_seconds(seconds).alias("Date"), F.col("open").alias("Open"), F.col("high").alias("High"),
        F.col("low").alias("Low"), F.col("close").alias("Close"),
        (volume + F.when(k % 2 == 0, 0.25).otherwise(0.75)).alias("Volume"),
        (volume / F.lit(100.0)).alias("Dividends"), F.when(k % 3 == 0, 2.0).otherwise(0.0).alias("Stock Splits"),
        F.col("symbol").alias("Symbol"))


def master_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A master list as CSV text without a header: quoted names with commas
    and doubled quotes, short records for ``k % 10 = 4``, surplus ones for ``k % 10 = 8``."""
    k, q = F.col("s_suppkey"), F.lit('"')
    name = F.when(k % 10 == 6, F.concat(F.lit('The ""'), "s_name", F.lit('"", Ltd'))).otherwise(F.concat("s_name", F.lit(", Ltd")))
    quoted = F.concat(_symbol(k), F.lit(","), q, name, q)
    line = F.when(k % 10 == 4, _symbol(k)).when(k % 10 == 8, F.concat(quoted, F.lit(",surplus"))).otherwise(quoted)
    return table(spark, sf_dir, "supplier").select(line.alias("value"))
