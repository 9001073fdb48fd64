"""Resampling daily prices into weekly and monthly OHLCV bars (A1-A3, J1-J3,
I7, I8).

The reference builds a bar from four relations joined on (symbol, period)
and (symbol, day). Here one ``groupBy`` does it: ``min_by``/``max_by`` take
the open of the first and the close of the last traded day, so a bar costs
one partial + final hash aggregate and one shuffle of the pre-aggregated
rows, whatever the skew of a symbol.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barforge.functions import month_key, week_key
from barforge.schemas import BAR_COLUMNS

PERIOD_KEYS = {"week": ("week_ending_friday", week_key),
               "month": ("month_end", month_key)}


def period_key(period: str) -> tuple[str, Column]:
    try:
        name, fn = PERIOD_KEYS[period]
    except KeyError:
        raise ValueError(f"period must be one of {sorted(PERIOD_KEYS)}, got {period!r}")
    return name, fn("date")


def period_boundaries(daily: DataFrame, period: str) -> DataFrame:
    """First and last traded day per symbol and period (A1)."""
    name, key = period_key(period)
    return (daily.groupBy("symbol", key.alias(name))
                 .agg(F.min("date").alias("first_day"), F.max("date").alias("last_day")))


def period_open(daily: DataFrame, period: str) -> DataFrame:
    """Open of the first traded day of each period (J2); NULL opens kept."""
    name, key = period_key(period)
    return (daily.groupBy("symbol", key.alias(name))
                 .agg(F.min("date").alias("first_day"),
                      F.min_by("open", "date").alias("open")))


def period_close(daily: DataFrame, period: str) -> DataFrame:
    """Close of the last traded day of each period."""
    name, key = period_key(period)
    return (daily.groupBy("symbol", key.alias(name))
                 .agg(F.max("date").alias("last_day"),
                      F.max_by("close", "date").alias("close")))


def resample_bars(daily: DataFrame, period: str = "week") -> DataFrame:
    """OHLCV bars; the bar's date is its last traded day.

    ``daily`` must hold one row per (symbol, date), as staging does."""
    _, key = period_key(period)
    return (daily.groupBy("symbol", key.alias("_period"))
                 .agg(F.max("date").alias("date"),
                      F.min_by("open", "date").alias("open"),
                      F.max("high").alias("high"),
                      F.min("low").alias("low"),
                      F.max_by("close", "date").alias("close"),
                      F.sum("volume").alias("volume"))
                 .select(*BAR_COLUMNS))


def bar_segments(daily: DataFrame) -> DataFrame:
    """Day ranges from which weekly and monthly bars both fold, so one pass
    over ``daily`` feeds the two outputs.

    Days are first folded into segments keyed by (symbol, week, month): at
    most two segments per symbol-week, so the segment table is a few times
    smaller than the daily one. Both bar tables are then folded from the
    segments. Open/close compose because segments of one period cover
    disjoint day ranges. The caller should checkpoint or write the
    segments, so daily staging is computed once for both outputs."""
    seg = (daily.groupBy("symbol", week_key("date").alias("_week"),
                         month_key("date").alias("_month"))
                .agg(F.min("date").alias("first_day"),
                     F.max("date").alias("last_day"),
                     F.min_by("open", "date").alias("open"),
                     F.max("high").alias("high"),
                     F.min("low").alias("low"),
                     F.max_by("close", "date").alias("close"),
                     F.sum("volume").alias("volume")))
    return seg


def fold_segments(seg: DataFrame, period: str) -> DataFrame:
    """Bars of ``period`` from the segments of ``bar_segments``."""
    key = {"week": "_week", "month": "_month"}[period]
    return (seg.groupBy("symbol", key)
               .agg(F.max("last_day").alias("date"),
                    F.min_by("open", "first_day").alias("open"),
                    F.max("high").alias("high"),
                    F.min("low").alias("low"),
                    F.max_by("close", "last_day").alias("close"),
                    F.sum("volume").alias("volume"))
               .select(*BAR_COLUMNS))
