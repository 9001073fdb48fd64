"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory, each over the whole fixture tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.functions import bar_key, month_key, typical_price, week_key
from barforge.operators import bars, incremental as inc, indicators as ind, quality, staging
from barforge.operators.ordering import with_position
from barforge.operators.upsert import dedup_by_key, upsert
from barforge.plans.incremental import read_control, run_incremental, write_control
from barforge.schemas import BRONZE, conform
from barforge.sources import fixtures as fx, storage
from barforge.sources.landing import (
    normalize_landing, read_bronze, stored_stats, table_stats, to_bronze, with_exchange_zone,
)
from barforge.sources.master import load_master, master_symbols, rejects_path
from barforge.sources.storage import materialise, staging_path

Query = Callable[[SparkSession, str], DataFrame]


def _stg(spark, sf):
    return staging.stage_daily(fx.prices(spark, sf))


def _weekly(spark, sf):
    return bars.resample_bars(_stg(spark, sf), "week")


def _ind(spark, sf):
    return ind.indicators(_weekly(spark, sf))


def _gold(spark, sf):
    return ind.weekly_technical_analysis(materialise(_weekly(spark, sf)))


def _silver_gold() -> dict[str, Query]:
    q: dict[str, Query] = {
        "stg_not_null": lambda s, d: staging.not_null(fx.prices(s, d).select(*staging.STAGING_COLUMNS)),
        "stg_daily_prices": _stg,
        "week_key": lambda s, d: _stg(s, d).select(
            "symbol", "date", week_key("date").alias("week_ending_friday")),
        "month_key": lambda s, d: _stg(s, d).select(
            "symbol", "date", month_key("date").alias("month_end")),
        "week_boundaries": lambda s, d: bars.period_boundaries(_stg(s, d), "week"),
        "month_boundaries": lambda s, d: bars.period_boundaries(_stg(s, d), "month"),
        "period_open": lambda s, d: bars.period_open(_stg(s, d), "week"),
        "period_close": lambda s, d: bars.period_close(_stg(s, d), "week"),
        "weekly_prices": _weekly,
        "monthly_prices": lambda s, d: bars.resample_bars(_stg(s, d), "month"),
        "benchmarks": lambda s, d: ind.benchmarks(_weekly(s, d)),
        "benchmark_join": lambda s, d: _ind(s, d).select(
            "date", "symbol", "close", "nifty50_close", "nifty500_close"),
        "exclude_benchmarks": lambda s, d: ind.exclude_symbols(_weekly(s, d)),
        "typical_price": lambda s, d: ind.exclude_symbols(_weekly(s, d)).select(
            "date", "symbol", typical_price().alias("typical_price")),
        "tp_sma_34": lambda s, d: _ind(s, d).select(
            "date", "symbol", F.round("tp_sma", 6).alias("tp_sma_34"),
            F.col("cci_count")),
        "sma_30": lambda s, d: _ind(s, d).select(
            "date", "symbol",
            ind.sma_value(F.col("sma_raw"), F.col("sma_count")).alias("sma_30"),
            F.col("sma_count").alias("sma_30_count")),
        "sma_warmup": lambda s, d: ind.warmup(_ind(s, d)).select(
            "date", "symbol", "close", F.col("sma_count").alias("sma_30_count")),
        "cci_34": lambda s, d: _ind(s, d).select(
            "date", "symbol", "typical_price",
            ind.cci_value(F.col("typical_price"), F.col("tp_sma"), F.col("cci_count"))
               .alias("cci_34")),
        "rs_nifty50": lambda s, d: _ind(s, d).select("date", "symbol", "close", "rs_nifty50"),
        "rs_nifty500": lambda s, d: _ind(s, d).select("date", "symbol", "close", "rs_nifty500"),
        # Weekly bars are planned once: both sides of the benchmark join read them back.
        "weekly_technical_analysis": lambda s, d: _gold(s, d),
        "ordered_gold": lambda s, d: with_position(_gold(s, d), ["symbol", "date"]),
    }
    for n in ind.BREAKOUT_WEEKS:
        q[f"breakout_{n}w"] = (lambda n: lambda s, d: _ind(s, d).select(
            "date", "symbol", "close", f"prev_high_{n}w", ind.breakout_name(n)))(n)
    return q


def _run(spark, sf) -> inc.IncrementalRun:
    """The incremental-load fixture run: first pass over the landing files,
    retry over landing plus late landing."""
    land = normalize_landing(fx.landing(spark, sf), "UTC")
    late = normalize_landing(fx.landing(spark, sf, late=True), "UTC")
    return inc.plan_run(fx.master(spark, sf), fx.control(spark, sf), land, fx.RUN_DATE,
                        retry_landing_norm=land.unionByName(late))


def _wm(spark, sf):
    return inc.read_watermarks(fx.control(spark, sf))


def _classified(spark, sf):
    return inc.classify(fx.master(spark, sf), _wm(spark, sf), fx.RUN_DATE)


def _plan(spark, sf):
    return inc.extract_plan(_classified(spark, sf), fx.RUN_DATE)


def _bronze_cols(df):
    return df.select(*[f.name for f in BRONZE.fields])


def _incremental() -> dict[str, Query]:
    return {
        "watermarks": _wm,
        "symbol_classification": _classified,
        "new_symbols": lambda s, d: inc.new_symbols(fx.master(s, d), _wm(s, d)),
        "known_symbols": lambda s, d: inc.known_symbols(fx.master(s, d), _wm(s, d)),
        "class_counts": lambda s, d: inc.class_counts(_classified(s, d)),
        "delta_start_date": lambda s, d: inc.delta_start_date(_classified(s, d)),
        "extract_plan": _plan,
        "extract_planned": lambda s, d: _run(s, d).extracted,
        "extract_results": lambda s, d: _run(s, d).success.select(*inc.RESULT_COLUMNS),
        "failed_results": lambda s, d: _run(s, d).failed.select(*inc.RESULT_COLUMNS),
        "retry_plan": lambda s, d: _run(s, d).retry_plan,
        "control_upsert": lambda s, d: inc.control_upsert(
            fx.control(s, d), _run(s, d).results, fx.RUN_ID, fx.RUN_TS),
        "control_upsert_first_pass": lambda s, d: inc.control_upsert(
            fx.control(s, d), _run(s, d).first_pass_results, fx.RUN_ID, fx.RUN_TS),
        "run_summary": lambda s, d: (lambda r: inc.run_summary(
            r.classified, r.results, r.all_extracted))(_run(s, d)),
        "run_summary_first_pass": lambda s, d: (lambda r: inc.run_summary(
            r.classified, r.first_pass_results, r.extracted))(_run(s, d)),
        "failed_symbols": lambda s, d: inc.failed_symbols(_run(s, d).results),
        "failed_symbols_first_pass": lambda s, d: inc.failed_symbols(_run(s, d).first_pass_results),
        "incremental_run": lambda s, d: _bronze_cols(staging.keep_first(
            _bronze_cols(_run(s, d).all_extracted), ["symbol", "date"])),
    }


def _bronze() -> dict[str, Query]:
    def upserted(s, d):
        target, source = fx.upsert_pair(s, d)
        return upsert(target, source, ["symbol", "date"])

    return {
        "scan_bronze": lambda s, d: conform(fx.trades(s, d).drop("stock_splits"), BRONZE),
        "master_symbols": lambda s, d: master_symbols(fx.constituents(s, d)),
        "landing_normalized": lambda s, d: normalize_landing(fx.landing_all(s, d), "UTC"),
        "nan_to_null": lambda s, d: normalize_landing(fx.landing_with_nan(s, d), "UTC"),
        # A feed without dividends and splits: what is there in order, the rest NULL.
        "landing_tolerant": lambda s, d: to_bronze(
            normalize_landing(fx.landing_all(s, d).drop("Dividends", "Stock Splits"), "UTC")),
        # First load: the de-duplicated source is the table.
        "bronze_first_load": lambda s, d: _bronze_cols(dedup_by_key(
            to_bronze(normalize_landing(fx.landing_all(s, d), "UTC")), ["symbol", "date"], staging.DEDUP_ORDER)),
        "bronze_upsert": upserted,
        "table_stats": lambda s, d: table_stats(upserted(s, d)),
        "union_extracts": lambda s, d: _run(s, d).all_extracted,
    }


def _stored() -> dict[str, Query]:
    """What production stores, read back from published tables."""
    def upserted(s, d, partitions):
        target, source = fx.upsert_pair(s, d)
        path = staging_path(s)
        storage.upsert_table(s, target, path, partitions=partitions)
        storage.upsert_table(s, source, path, partitions=partitions)
        return path

    def stats(s, d):
        # One file per month: the layout is ordered by the partition alone.
        path = staging_path(s)
        storage.replace_table(upsert(*fx.upsert_pair(s, d), ["symbol", "date"]), path, storage.month_partition(), sort_by=())
        return stored_stats(s, path)

    def ran(s, d) -> tuple[str, str]:
        root = staging_path(s)
        land = normalize_landing(fx.landing(s, d), "UTC")
        late = normalize_landing(fx.landing(s, d, late=True), "UTC")
        write_control(s, fx.control(s, d), f"{root}/control")
        run_incremental(s, fx.master(s, d), land, f"{root}/control", f"{root}/bronze", fx.RUN_DATE, fx.RUN_TS, fx.RUN_ID,
                        retry_landing_norm=land.unionByName(late))
        return f"{root}/control", f"{root}/bronze"

    def view(s, d):
        path = staging_path(s)
        storage.replace_table(fx.prices(s, d), path, storage.month_partition())
        name = storage.create_view(s, storage.table_name(s, path) + "_stg", staging.staging_sql(storage.table_sql(s, path)))
        return s.table(name)

    def from_csv(s, d):
        path = staging_path(s)
        fx.master_lines(s, d).write.text(path)
        good = load_master(s, path, header=False)
        rejects = s.read.text(rejects_path(path)).withColumnRenamed("value", "record")
        return good.unionByName(rejects, allowMissingColumns=True)

    return {
        "bronze_stored_upsert": lambda s, d: _bronze_cols(storage.read_table(s, upserted(s, d, storage.month_partition()))),
        "bronze_stored_run": lambda s, d: read_bronze(s, ran(s, d)[1]),
        "control_stored": lambda s, d: read_control(s, ran(s, d)[0]),
        "stored_stats": stats,
        # Weekly bars stored in buckets by symbol: gold over them has no exchange on the symbol.
        "gold_bucketed": lambda s, d: ind.weekly_technical_analysis(
            storage.replace_table(_weekly(s, d), staging_path(s), buckets=8)),
        "stg_view": view,
        "master_from_csv": from_csv,
        "landing_exchange_day": lambda s, d: normalize_landing(
            with_exchange_zone(fx.landing_by_hour(s, d), fx.master_with_zones(s, d)), F.col("exchange_tz")),
    }


def _layers(spark, sf) -> dict[str, DataFrame]:
    stg = materialise(_stg(spark, sf))
    weekly = materialise(bars.resample_bars(stg, "week"))
    return {"stg_daily_prices": stg, "weekly_prices": weekly,
            "monthly_prices": bars.resample_bars(stg, "month"),
            "weekly_technical_analysis": ind.weekly_technical_analysis(weekly)}


def _checks() -> dict[str, Query]:
    def not_null(s, d):
        # The glitchy feed after NaN -> NULL: the close check has work to do.
        raw = normalize_landing(fx.landing_with_nan(s, d), "UTC")
        return quality.layer_report("landing", raw, not_null=["date", "symbol", "close"])

    def unique(s, d):
        return (quality.layer_report("bronze", fx.prices(s, d), unique=[quality.BAR_KEY_EXPR])
                .unionByName(quality.layer_report("stg_daily_prices", _stg(s, d),
                                                  unique=[quality.BAR_KEY_EXPR])))

    def accepted(s, d):
        spec = quality.SUITE["weekly_technical_analysis"]["accepted_values"]
        return quality.layer_report("weekly_technical_analysis",
                                    ind.weekly_technical_analysis(_weekly(s, d)),
                                    accepted_values=spec)

    return {
        "bar_key": lambda s, d: _stg(s, d).select("symbol", "date", bar_key().alias("bar_key")),
        "check_not_null": not_null,
        "check_unique": unique,
        "check_accepted_values": accepted,
        "quality_report": lambda s, d: quality.quality_report(_layers(s, d)),
    }


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    out.update(_bronze())
    out.update(_silver_gold())
    out.update(_incremental())
    out.update(_checks())
    out.update(_stored())
    return out
