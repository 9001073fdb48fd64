"""Incremental silver and gold refresh give the same tables as a full rebuild."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from barforge.operators import indicators
from barforge.plans.changes import read_changes, record_changes
from barforge.plans.incremental import run_incremental
from barforge.plans.transform import TransformPaths, read_bars, read_gold, run_transform
from barforge.sources import fixtures as fx, storage
from barforge.sources.landing import normalize_landing
from conftest import SF_SMALL, bronze_rows

CRASH_SINCE = dt.date(1999, 3, 17)


def tables(spark, paths):
    return {"w": sorted(read_bars(spark, paths.weekly).collect()),
            "m": sorted(read_bars(spark, paths.monthly).collect()),
            "g": sorted(read_gold(spark, paths.technical).collect())}


def lake_paths(lake):
    return TransformPaths(silver=f"{lake}/silver", gold=f"{lake}/gold")


# 156 weeks: the normal calendar context; 20 weeks: too short for the 104-bar
# frames, so every symbol takes the full-history fallback.
@pytest.mark.parametrize("context_weeks", [156, 20])
def test_incremental_refresh_equals_full_rebuild(spark, context_weeks):
    """A first load and full transform, a second load (plus an older record, as a crash would leave), a refresh."""
    root = tempfile.mkdtemp(prefix="barforge-refresh-")
    lake, changes = f"{root}/lake", f"{root}/lake/changes"
    paths, master = lake_paths(lake), fx.master(spark, SF_SMALL)
    land = normalize_landing(fx.landing(spark, SF_SMALL), "UTC").unionByName(
        normalize_landing(fx.landing(spark, SF_SMALL, late=True), "UTC"))
    r1 = dt.date(1999, 7, 1)
    run_incremental(spark, master, land.where(F.col("date") < F.lit(r1)), f"{lake}/control",
                    f"{lake}/bronze", r1, run_id="r1", changes_path=changes)
    run_transform(spark, f"{lake}/bronze", paths, changes_path=changes)
    assert read_changes(spark, changes).loads == []
    first_gold = read_gold(spark, paths.technical).count()
    run_incremental(spark, master, land, f"{lake}/control", f"{lake}/bronze", fx.RUN_DATE,
                    run_id="r2", changes_path=changes)
    since = read_changes(spark, changes).symbols.agg(F.min("since")).first()[0]
    assert since is not None and since >= dt.date(1999, 6, 1)
    rows = storage.read_table(spark, f"{lake}/bronze").where(F.col("date") >= F.lit(CRASH_SINCE))
    record_changes(spark, changes, rows, "crashed")
    full = lake_paths(f"{root}/full")
    run_transform(spark, f"{lake}/bronze", full)
    expected = tables(spark, full)

    def old_files(path):
        return sorted(storage.read_table(spark, path).where("month < 199903").inputFiles())

    before = {p: old_files(p) for p in (paths.weekly, paths.monthly, paths.technical)}
    report = run_transform(spark, f"{lake}/bronze", paths, changes_path=changes, gold_context_weeks=context_weeks)
    assert report.where("violations > 0").count() == 0 and read_changes(spark, changes).loads == []
    assert {p: old_files(p) for p in before} == before   # older months not rewritten
    got = tables(spark, paths)
    assert len(got["g"]) > first_gold and got == expected
    # nothing changed and silver present: no recomputation, same tables
    run_transform(spark, f"{lake}/bronze", paths, changes_path=changes)
    assert tables(spark, paths) == expected


def weekly_rows(symbols, weeks, close=1.0):
    start = dt.date(2020, 1, 6)
    return [(start + dt.timedelta(weeks=w, days=d), s, close, close + 1, close - 0.5, close + w % 7, 10)
            for s in symbols for w in range(weeks) for d in (0, 2)]


@pytest.mark.parametrize("symbol", ["B", "NIFTY50"])
def test_backfill_of_one_symbol_computes_that_symbol_only(spark, scratch, monkeypatch, symbol):
    bronze, changes, paths = f"{scratch}/bronze", f"{scratch}/changes", lake_paths(scratch)
    symbols = ["A", "B", "C", "NIFTY50", "NIFTY500"]
    storage.upsert_table(spark, bronze_rows(spark, weekly_rows(symbols, 60)), bronze, partitions=storage.month_partition())
    run_transform(spark, bronze, paths)
    before = tables(spark, paths)
    # Two years before the listing, and one corrected day.
    back = [(d - dt.timedelta(weeks=104), *r) for d, *r in weekly_rows([symbol], 104, 3.0)]
    back += [(dt.date(2020, 6, 1), symbol, 9.0, 9.0, 9.0, 9.0, 99)]
    change = storage.plan_upsert(spark, bronze_rows(spark, back), bronze, partitions=storage.month_partition())
    storage.apply_upsert(spark, change, before_publish=lambda c: record_changes(spark, changes, c.rows, "back"))
    assert [r.symbol for r in read_changes(spark, changes).symbols.collect()] == [symbol]

    from barforge.operators import bars, staging
    staged, weighed = [], []
    stage, gold = staging.stage_daily, indicators.weekly_technical_analysis

    def spy_stage(rows):
        staged.append(rows)
        return stage(rows)

    def spy_gold(rows, *a):
        weighed.append(rows)
        return gold(rows, *a)

    monkeypatch.setattr(staging, "stage_daily", spy_stage)
    monkeypatch.setattr(indicators, "weekly_technical_analysis", spy_gold)
    report = run_transform(spark, bronze, paths, changes_path=changes)
    assert report.where("violations > 0").count() == 0
    # Only the backfilled symbol's rows enter the bars, and the scan is told so.
    assert {r.symbol for r in staged[0].select("symbol").distinct().collect()} == {symbol}
    plan = staged[0]._jdf.queryExecution().executedPlan().toString()
    assert f"EqualTo(symbol,{symbol})" in plan or f"In(symbol, [{symbol}])" in plan
    # Gold weighs it and the benchmarks; a benchmark touches the relative strength of all.
    entered = {r.symbol for r in weighed[0].select("symbol").distinct().collect()}
    assert entered == ({symbol, "NIFTY50", "NIFTY500"} if symbol == "B" else set(symbols))
    after = tables(spark, paths)
    assert [r for r in after["w"] if r.symbol != symbol] == [r for r in before["w"] if r.symbol != symbol]
    monkeypatch.undo()
    full = lake_paths(f"{scratch}/full")
    run_transform(spark, bronze, full)
    assert after == tables(spark, full) and after != before
