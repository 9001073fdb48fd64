from pyspark.sql import functions as F

from barforge.operators.staging import stage_daily
from barforge.sources.landing import normalize_landing
from barforge.schemas import LANDING
from conftest import D, bronze_rows


def test_null_volume_duplicate_is_kept(spark):
    df = bronze_rows(spark, [("2024-03-01", "A", 1.0, 2.0, 0.5, 1.5, None),
                             ("2024-03-01", "A", 1.0, 2.0, 0.5, 1.6, 10)])
    out = stage_daily(df).collect()
    assert len(out) == 1 and out[0]["volume"] is None and out[0]["close"] == 1.5


def test_largest_volume_wins_and_ties_break_on_close(spark):
    df = bronze_rows(spark, [("2024-03-01", "A", 1.0, 2.0, 0.5, 1.5, 5),
                             ("2024-03-01", "A", 1.0, 2.0, 0.5, 1.7, 9),
                             ("2024-03-01", "A", 1.0, 2.0, 0.5, 1.9, 9)])
    out = stage_daily(df).collect()
    assert [(r["volume"], r["close"]) for r in out] == [(9, 1.9)]


def test_null_and_nan_close_dropped(spark):
    nan = float("nan")
    land = spark.createDataFrame(
        [(D("2024-03-01"), 1.0, 2.0, 0.5, None, 10.0, 0.0, 0.0, "A"),
         (D("2024-03-04"), 1.0, 2.0, 0.5, nan, 10.0, 0.0, 0.0, "A"),
         (D("2024-03-05"), 1.0, 2.0, 0.5, 1.5, 10.0, 0.0, 0.0, "A")],
        "Date date, Open double, High double, Low double, Close double, Volume double, "
        "Dividends double, `Stock Splits` double, Symbol string")
    bronze = normalize_landing(land, "UTC")
    assert bronze.where(F.isnan("close")).count() == 0
    out = stage_daily(bronze).collect()
    assert [r["date"] for r in out] == [D("2024-03-05")]
    assert LANDING["Date"]  # declared landing schema exists


def test_required_columns(spark):
    df = bronze_rows(spark, [("2024-03-01", None, 1.0, 2.0, 0.5, 1.5, 1),
                             ("2024-03-01", "B", None, None, None, 1.5, None)])
    out = stage_daily(df).collect()
    assert [r["symbol"] for r in out] == ["B"]  # open/high/low/volume may be NULL
