import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from barforge.functions import week_key
from barforge.operators import bars
from barforge.operators.staging import stage_daily
from conftest import D, bronze_rows


def test_weekend_rows_join_week_just_ended(spark):
    df = bronze_rows(spark, [(d, "A", 1.0, 2.0, 0.5, 1.5, 1) for d in
                             ("2024-03-01", "2024-03-02", "2024-03-03", "2024-03-04")])
    keys = {r["date"]: r["k"] for r in df.select("date", week_key("date").alias("k")).collect()}
    assert keys[D("2024-03-01")] == keys[D("2024-03-02")] == keys[D("2024-03-03")] == D("2024-03-01")
    assert keys[D("2024-03-04")] == D("2024-03-08")
    w = bars.resample_bars(df, "week").orderBy("date").collect()
    assert [r["date"] for r in w] == [D("2024-03-03"), D("2024-03-04")]


def test_short_week_bar_date_is_last_traded_day(spark):
    df = bronze_rows(spark, [(d, "A", 1.0, 2.0, 0.5, 1.5, 1) for d in
                             ("2024-03-04", "2024-03-05", "2024-03-06", "2024-03-07")])
    (r,) = bars.resample_bars(df, "week").collect()
    assert r["date"] == D("2024-03-07")


def test_null_open_on_first_day_kept(spark):
    df = bronze_rows(spark, [("2024-03-04", "A", None, 2.0, 0.5, 1.5, 3),
                             ("2024-03-05", "A", 2.0, 3.0, 0.5, 2.5, 4)])
    (w,) = bars.resample_bars(df, "week").collect()
    assert w["open"] is None and w["close"] == 2.5 and w["high"] == 3.0 and w["volume"] == 7
    (m,) = bars.resample_bars(df, "month").collect()
    assert m["open"] is None and m["date"] == D("2024-03-05")


day = st.dates(min_value=dt.date(2023, 12, 20), max_value=dt.date(2024, 2, 10))
row = st.tuples(day, st.sampled_from(["A", "B"]),
                st.one_of(st.none(), st.floats(1, 100)), st.floats(1, 100),
                st.floats(1, 100), st.one_of(st.none(), st.integers(0, 50)))


@settings(max_examples=8, deadline=None)
@given(st.lists(row, min_size=1, max_size=40))
def test_segments_fold_equals_direct_resample(spark, rows):
    data = [(d, s, o, max(h, lo), min(h, lo), (h + lo) / 2, v) for d, s, o, h, lo, v in rows]
    daily = stage_daily(bronze_rows(spark, data))
    seg = bars.bar_segments(daily)
    for period in ("week", "month"):
        a = sorted(bars.resample_bars(daily, period).collect())
        b = sorted(bars.fold_segments(seg, period).collect())
        assert a == b
    # volume is conserved and low <= close <= high holds on every bar
    w = bars.resample_bars(daily, "week")
    assert (w.agg(F.sum("volume")).first()[0] == daily.agg(F.sum("volume")).first()[0])
    assert w.where((F.col("low") > F.col("close")) | (F.col("close") > F.col("high"))).count() == 0


def test_bars_do_not_depend_on_row_order(spark):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), "A", 1.0 + i, 2.0 + i, 0.5, 1.5 + i, i)
            for i in range(30)]
    a = sorted(bars.resample_bars(bronze_rows(spark, rows), "week").collect())
    b = sorted(bars.resample_bars(bronze_rows(spark, rows[::-1]).repartition(3), "week").collect())
    assert a == b
