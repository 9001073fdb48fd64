"""Stored layers: positions, buckets, views, footers, zones by row, master lists with bad records."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barforge.operators import staging
from barforge.operators.indicators import weekly_technical_analysis
from barforge.operators.ordering import with_position
from barforge.plans.transform import TransformPaths, read_bars, read_gold, run_transform
from barforge.sources import fixtures as fx, storage
from barforge.sources.landing import footer_stats, normalize_landing, stored_stats, with_exchange_zone
from barforge.sources.master import load_master, rejects_path
from conftest import D, SF_SMALL, bronze_rows


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_position_is_the_global_row_number(spark, n):
    rows = spark.range(n).select((F.col("id") * 7919 % 1009).alias("a"), (F.col("id") % 3).cast("string").alias("position_of")).repartition(7)
    out = with_position(rows, ["a"], "nth")
    assert out.columns == ["a", "position_of", "nth"]
    got = sorted(out.collect(), key=lambda r: r.nth)
    assert [r.nth for r in got] == list(range(1, n + 1)) and [r.a for r in got] == sorted(r.a for r in got)
    # The only window without a partition is over one row per input partition.
    assert plan_of(out).count("Window") <= 2


def weeks(symbols, n):
    start = dt.date(2020, 1, 6)
    return [(start + dt.timedelta(weeks=w), s, 1.0, 2.0 + w % 5, 0.5, 1.0 + w % 7, 10) for s in symbols for w in range(n)]


def test_gold_over_buckets_has_one_window_and_no_exchange_on_symbol(spark, scratch):
    bronze, symbols = f"{scratch}/bronze", ["A", "B", "C", "D", "NIFTY50", "NIFTY500"]
    storage.upsert_table(spark, bronze_rows(spark, weeks(symbols, 45)), bronze, partitions=storage.month_partition())
    plain = TransformPaths(silver=f"{scratch}/s1", gold=f"{scratch}/g1")
    bucketed = TransformPaths(silver=f"{scratch}/s2", gold=f"{scratch}/g2", buckets=4)
    for paths in (plain, bucketed):
        assert run_transform(spark, bronze, paths).where("violations > 0").count() == 0
    assert sorted(read_gold(spark, plain.technical).collect()) == sorted(read_gold(spark, bucketed.technical).collect())
    gold = weekly_technical_analysis(read_bars(spark, bucketed.weekly))
    plan = plan_of(gold)
    assert plan.count("Window [") == 1 and "hashpartitioning(symbol" not in plan and "Bucketed: true" in plan
    assert "hashpartitioning(symbol" in plan_of(weekly_technical_analysis(read_bars(spark, plain.weekly)))
    assert sorted(gold.collect()) == sorted(read_gold(spark, plain.technical).collect())
    # A rebuild and a refresh keep the layout; another number of buckets is refused.
    run_transform(spark, bronze, bucketed, full=True)
    assert "hashpartitioning(symbol" not in plan_of(weekly_technical_analysis(read_bars(spark, bucketed.weekly)))
    with pytest.raises(ValueError, match="4 buckets"):
        run_transform(spark, bronze, TransformPaths(silver=bucketed.silver, gold=bucketed.gold, buckets=2), full=True)


def test_view_is_read_by_other_sessions_and_follows_versions(spark, scratch):
    path = f"{scratch}/bronze"
    storage.upsert_table(spark, fx.prices(spark, SF_SMALL), path, partitions=storage.month_partition())
    name = storage.create_view(spark, "views_t.stg_daily_prices", staging.staging_sql(storage.table_sql(spark, path)))
    other = spark.newSession()
    expected = sorted(staging.stage_daily(fx.prices(spark, SF_SMALL)).collect())
    assert sorted(other.table(name).collect()) == expected
    storage.upsert_table(spark, bronze_rows(spark, [("2030-01-07", "Z", 1.0, 1.0, 1.0, 1.0, 1)]), path, partitions=storage.month_partition())
    assert other.table(name).count() == len(expected) + 1


def test_registered_layers_follow_versions(spark, scratch):
    bronze, paths = f"{scratch}/bronze", TransformPaths(silver=f"{scratch}/silver", gold=f"{scratch}/gold")
    storage.upsert_table(spark, bronze_rows(spark, weeks("AB", 3)), bronze, partitions=storage.month_partition())
    run_transform(spark, bronze, paths, register=True, silver_schema="silver_v", gold_schema="gold_v")
    assert spark.newSession().table("silver_v.weekly_prices").count() == 6
    storage.upsert_table(spark, bronze_rows(spark, weeks("ABC", 3)), bronze, partitions=storage.month_partition())
    run_transform(spark, bronze, paths)
    assert spark.newSession().table("silver_v.weekly_prices").count() == 9


def test_statistics_come_from_footers(spark, scratch):
    path = f"{scratch}/bronze"
    rows = bronze_rows(spark, [(f"2024-{m:02d}-05", s, 1.0, 1.0, 1.0, 1.0, 1) for m in range(1, 7) for s in "ABC"])
    storage.replace_table(rows, path, storage.month_partition(), sort_by=())
    plan = plan_of(footer_stats(spark, path))
    assert "PushedAggregation: [COUNT(*), MIN(date), MAX(date)]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    assert [tuple(r) for r in stored_stats(spark, path).collect()] == [(6, 18, 3, D("2024-01-05"), D("2024-06-05"))]
    empty = storage.write_version(rows.limit(0), f"{scratch}/none", storage.month_partition())
    storage.publish(spark, empty)
    assert [tuple(r) for r in stored_stats(spark, f"{scratch}/none").collect()] == [(0, 0, 0, None, None)]


def test_day_is_counted_in_each_symbols_zone(spark):
    land = spark.createDataFrame(
        [(dt.datetime(2024, 3, 10, h, 30, tzinfo=dt.timezone.utc), 1.0, 1.0, 1.0, 1.0, 1.9, 0.5, 2.0, s)
         for h in (3, 4, 5, 19) for s in ("I", "N")] + [(None, 1.0, 1.0, 1.0, 1.0, 1.0, 0.0, 0.0, "I")],
        "Date timestamp, Open double, High double, Low double, Close double, Volume double, Dividends double, "
        "`Stock Splits` double, Symbol string")
    zones = spark.createDataFrame([("I", "Asia/Kolkata"), ("N", "America/New_York"), ("I", "Asia/Kolkata")], "symbol string, exchange_tz string")
    out = normalize_landing(with_exchange_zone(land, zones), F.col("exchange_tz")).collect()
    days = {(r.symbol, str(r.date)): sum(x.symbol == r.symbol and x.date == r.date for x in out) for r in out}
    # New York is at -5 until 07:00 UTC of that day: 04:30 is still the 9th, 05:30 is the 10th.
    assert days == {("I", "2024-03-10"): 3, ("I", "2024-03-11"): 1, ("I", "None"): 1, ("N", "2024-03-09"): 2, ("N", "2024-03-10"): 2}
    assert {r.volume for r in out} == {1} and {r.dividends for r in out} == {0.5, 0.0}
    with pytest.raises(Exception, match="no exchange zone for symbol N"):
        normalize_landing(with_exchange_zone(land, zones.where("symbol = 'I'")), F.col("exchange_tz")).collect()


def test_bad_records_of_a_master_list_are_kept_apart(spark, scratch):
    path = f"{scratch}/master.csv"
    with open(path, "w") as f:
        f.write('Symbol,Company Name\nA.NS,"X, Ltd"\nB.NS\nC.NS,Y,surplus\nD.NS,"say ""hi"""\n,nameless\nE.NS,\n')
    rows = load_master(spark, path)
    assert sorted(map(tuple, rows.collect())) == [("A.NS", "X, Ltd"), ("D.NS", 'say "hi"'), ("E.NS", None)]
    assert sorted(r.value for r in spark.read.text(rejects_path(path)).collect()) == [",nameless", "B.NS", "C.NS,Y,surplus"]
