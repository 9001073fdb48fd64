"""Entry B: bronze -> staging -> weekly / monthly bars -> gold, with checks.

Plan shape (per run):
  1. bronze scan (only the 9 columns) -> staging de-dup: one shuffle on
     (symbol, date), pre-limited to one row per key and map task;
  2. day -> (symbol, week, month) segments: one partial + final aggregate;
     segments are checkpointed to the shared checkpoint folder, so the
     daily data is read and de-duplicated once for both bar tables;
  3. weekly and monthly bars fold the segments (small aggregates), written
     as month-partitioned versions; gold reads the written weekly version
     back (lineage cut). After an incremental load only the weeks and months
     of changed symbols, from their earliest changed date on, are recomputed;
  4. gold: one Window node (single sort on symbol, date) over weekly rows;
     the benchmark side is an aggregate with one row per date;
  5. checks on the versions, then all tables are moved to them.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from barforge.operators import bars, indicators, quality, staging
from barforge.plans.changes import clear_changes, read_changes
from barforge.schemas import BARS, BENCHMARK_SYMBOLS, GOLD, conform
from barforge.session import ensure_checkpoint_dir
from barforge.sources import storage
from barforge.sources.landing import read_bronze


@dataclass
class TransformPaths:
    silver: str
    gold: str
    #: Buckets by symbol of the weekly table (0: none). With them gold's windows need no exchange.
    buckets: int = 0

    @property
    def weekly(self) -> str:
        return f"{self.silver.rstrip('/')}/weekly_prices"

    @property
    def monthly(self) -> str:
        return f"{self.silver.rstrip('/')}/monthly_prices"

    @property
    def technical(self) -> str:
        return f"{self.gold.rstrip('/')}/weekly_technical_analysis"


def build_silver(bronze: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(staging, weekly, monthly): staging is de-duplicated once (written),
    weekly and monthly share one checkpointed segment table."""
    stg = storage.materialise(staging.stage_daily(bronze))
    seg = bars.bar_segments(stg).checkpoint(eager=True)
    return stg, bars.fold_segments(seg, "week"), bars.fold_segments(seg, "month")


# Default namespaces of the two derived layers.
SILVER_SCHEMA = "silver"
GOLD_SCHEMA = "gold"


def silver_partition() -> dict:
    """Silver tables are stored by month of the bar date, so a refresh
    rewrites only the months it touches."""
    return storage.month_partition()


def stored_schema(schema: StructType) -> StructType:
    """A layer's columns and its partition column: also for a table without rows."""
    return StructType([*schema.fields, *(StructField(c, IntegerType()) for c in silver_partition())])


def read_bars(spark: SparkSession, path: str) -> DataFrame:
    """A stored bar table with its declared columns (partition column
    dropped)."""
    return conform(storage.read_table(spark, path, stored_schema(BARS)), BARS)


def _week_start(date: str = "since"):
    return F.trunc(date, "week")


#: Changed symbols up to this many reach the scan as an IN filter; beyond it the semi-join alone decides.
PUSHED_SYMBOLS = 1000


def _rows_of(df: DataFrame, bounds: DataFrame) -> DataFrame:
    """Rows of the symbols of ``bounds`` from their ``start`` on."""
    some = [r[0] for r in bounds.select("symbol").limit(PUSHED_SYMBOLS + 1).collect()]
    if len(some) <= PUSHED_SYMBOLS:
        df = df.where(F.col("symbol").isin(*some) if some else F.lit(False))
    return df.join(bounds.select("symbol", "start"), "symbol").where(F.col("date") >= F.col("start")).select(*df.columns)


def refresh_silver(spark: SparkSession, bronze_path: str, paths: TransformPaths,
                   changed: DataFrame) -> tuple[DataFrame, storage.Version, storage.Version]:
    """Incremental silver: for every changed symbol (``symbol``, ``since``)
    only its bars of weeks from Monday of ``since``'s week and of months from
    the 1st of its month can differ. They are recomputed from that symbol's
    bronze rows (partitions before the earliest date pruned, the symbols
    pushed into the scan); every other bar, of the same symbol or of others,
    is not computed. Returns the staging rows read and the two versions."""
    starts = changed.select("symbol", _week_start().alias("week"), F.trunc("since", "month").alias("month"))
    both = storage.materialise(starts.withColumn("start", F.least("week", "month")))
    lo = both.agg(F.min("start")).first()[0]
    stg, weekly, monthly = build_silver(_rows_of(read_bronze(spark, bronze_path, since=lo), both))
    out = []
    for fresh, column, path, n in ((weekly, "week", paths.weekly, paths.buckets), (monthly, "month", paths.monthly, 0)):
        bounds = both.select("symbol", F.col(column).alias("start"))
        # A period that began before its symbol's start is complete in the table already.
        rows = fresh.join(bounds, "symbol").where(F.col("date") >= F.col("start")).select(*fresh.columns)
        out.append(storage.replace_changed(spark, path, rows, bounds, silver_partition(), buckets=n))
    return stg, out[0], out[1]


# Calendar look-back read for an incremental gold refresh; it normally holds
# far more than the 104 preceding bars the widest indicator needs.
GOLD_CONTEXT_WEEKS = 156


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """The stored gold table with its declared columns."""
    return conform(storage.read_table(spark, path, stored_schema(GOLD)), GOLD)


def gold_bounds(weekly: DataFrame, changed: DataFrame) -> DataFrame:
    """``symbol``, ``start``: from when on gold rows can differ. A changed
    benchmark changes the relative strength of every symbol."""
    own = changed.select("symbol", _week_start().alias("start"))
    base = own.where(F.col("symbol").isin(*BENCHMARK_SYMBOLS)).agg(F.min("start")).first()[0]
    if base is None:
        return own
    others = weekly.where(F.col("date") >= F.lit(base)).select("symbol").distinct().withColumn("start", F.lit(base))
    return own.unionByName(others).groupBy("symbol").agg(F.min("start").alias("start"))


def refresh_gold(spark: SparkSession, paths: TransformPaths, weekly: DataFrame, changed: DataFrame,
                 context_weeks: int = GOLD_CONTEXT_WEEKS) -> storage.Version:
    """Incremental gold over ``weekly`` (the table as it will be published).
    Rows of a changed symbol from its start on are recomputed over a context
    that holds all the preceding bars any indicator reads: a calendar window
    of ``context_weeks``, plus the whole older history of the symbols that
    have fewer than ``lookback_bars()`` bars in that window (gaps, new
    listings), and the benchmarks. The window functions are therefore exact."""
    bounds = storage.materialise(gold_bounds(weekly, changed))
    lo = bounds.agg(F.min("start")).first()[0]
    need = indicators.lookback_bars()
    ctx_lo = lo - dt.timedelta(weeks=context_weeks)
    floor, ceiling = storage.partition_floor(weekly.columns, ctx_lo), storage.partition_ceiling(weekly.columns, ctx_lo)
    benchmark = F.col("symbol").isin(*BENCHMARK_SYMBOLS)
    recent = weekly.where(floor & (F.col("date") >= F.lit(ctx_lo)))
    recent = recent.join(bounds, "symbol", "left").where(F.col("start").isNotNull() | benchmark)
    have = recent.where(F.col("date") < F.col("start")).groupBy("symbol").agg(F.count(F.lit(1)).alias("_n"))
    short = bounds.join(have, "symbol", "left").where(F.coalesce("_n", F.lit(0)) < need).select("symbol")
    older = weekly.where(ceiling & (F.col("date") < F.lit(ctx_lo))).join(short, "symbol", "left_semi")
    context = conform(recent, BARS).unionByName(conform(older, BARS))
    fresh = indicators.weekly_technical_analysis(context)
    fresh = fresh.join(bounds, "symbol").where(F.col("date") >= F.col("start")).select(*[f.name for f in GOLD.fields])
    return storage.replace_changed(spark, paths.technical, fresh, bounds, silver_partition())


def run_transform(spark: SparkSession, bronze_path: str, paths: TransformPaths,
                  check_staging: bool = True, register: bool = False,
                  silver_schema: str | None = None, gold_schema: str | None = None,
                  changes_path: str | None = None,
                  gold_context_weeks: int = GOLD_CONTEXT_WEEKS, full: bool = False) -> DataFrame:
    """Build silver and gold from bronze; return the quality report of every
    layer (small, one row per check).

    Every layer is first written as a version that no reader sees. The
    checks run on those versions, and only if none is violated are they
    published and the change set cleared; else the tables stay as they were
    and the next run covers the change again. Without any bronze table, or
    with nothing changed, nothing is built or checked and the report is empty.

    Full rebuild when silver does not exist yet, when no change set is
    tracked, or with ``full``; else the changed symbols only
    (``refresh_silver``, ``refresh_gold``). The checks cover whole tables
    after a full build and the rewritten partitions after a refresh. NULLs
    are counted while the versions are written. With ``register``, the
    published layers are also views in the layer namespaces."""
    ensure_checkpoint_dir(spark)
    nothing = spark.createDataFrame([], "layer string, check string, column string, violations bigint")
    change = read_changes(spark, changes_path) if changes_path else None
    if not storage.table_exists(spark, bronze_path):
        return nothing
    have_layers = all(storage.table_exists(spark, p) for p in (paths.weekly, paths.monthly, paths.technical))
    if full or not have_layers or change is None:
        stg, weekly_rows, monthly_rows = build_silver(read_bronze(spark, bronze_path))
        weekly = storage.write_version(weekly_rows, paths.weekly, silver_partition(), buckets=paths.buckets)
        monthly = storage.write_version(monthly_rows, paths.monthly, silver_partition())
        gold = storage.write_version(indicators.weekly_technical_analysis(conform(weekly.rows(spark), BARS)),
                                     paths.technical, silver_partition())
    elif change.symbols.isEmpty():
        return nothing
    else:
        stg, weekly, monthly = refresh_silver(spark, bronze_path, paths, change.symbols)
        gold = refresh_gold(spark, paths, weekly.table(spark), change.symbols, gold_context_weeks)
    versions = {"weekly_prices": weekly, "monthly_prices": monthly, "weekly_technical_analysis": gold}
    # A (symbol, date) key can only repeat inside the partition that holds its date.
    layers = {name: v.rows(spark).drop(*v.columns) for name, v in versions.items()}
    nulls = {name: {k.removeprefix("null "): n for k, n in v.figures.items()} for name, v in versions.items()}
    if check_staging:
        layers = {"stg_daily_prices": stg, **layers}
    report = quality.quality_report(layers, known_nulls=nulls).checkpoint(eager=True)
    if not report.where("violations > 0").isEmpty():
        return report
    for version in versions.values():
        storage.publish(spark, version)
    if change is not None:
        clear_changes(spark, changes_path, change.loads)
    if register:
        storage.register_tables(spark, {"weekly_prices": paths.weekly,
                                        "monthly_prices": paths.monthly},
                                storage.layer_name(silver_schema, SILVER_SCHEMA))
        storage.register_tables(spark, {"weekly_technical_analysis": paths.technical},
                                storage.layer_name(gold_schema, GOLD_SCHEMA))
    return report
