"""Weekly technical indicators.

All window expressions share one spec, ``PARTITION BY symbol ORDER BY
date``, so Catalyst evaluates them in a single Window node after a single
sort. A weekly partition holds one row per traded week of a symbol, so its
size is bounded by the calendar (about 52 rows a year), not by data volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.functions import guarded_ratio, typical_price
from barforge.schemas import BAR_COLUMNS, BENCHMARK_SYMBOLS

# Fixed values of the reference's gold model.
SMA_LENGTH = 30
CCI_LENGTH = 34
CCI_CONSTANT = 0.015
BREAKOUT_WEEKS = (13, 26, 52, 104)
SMA_SCALE = 2
CCI_SCALE = 2
RS_SCALE = 6


def lookback_bars(sma_n: int = SMA_LENGTH, cci_n: int = CCI_LENGTH,
                  breakouts: Sequence[int] = BREAKOUT_WEEKS) -> int:
    """How many preceding bars any indicator of a bar reads (the widest
    frame): bars further back cannot change it."""
    return max([sma_n - 1, cci_n - 1, *breakouts])


def symbol_window():
    return Window.partitionBy("symbol").orderBy("date")


def trailing(n: int):
    """ROWS BETWEEN n-1 PRECEDING AND CURRENT ROW."""
    return symbol_window().rowsBetween(-(n - 1), Window.currentRow)


def benchmark_column(name: str) -> str:
    return f"{name.lower()}_close"


def benchmarks(weekly: DataFrame, names: Sequence[str] = BENCHMARK_SYMBOLS,
               every_date: bool = True) -> DataFrame:
    """One row per bar date with each benchmark's close (A4).

    ``every_date=True`` keeps every bar date (NULL where no benchmark
    traded), as the reference's table does. The gold join passes
    ``False``: dates without a benchmark would only produce NULLs in a left
    join, so ``symbol IN names`` is applied first and pushed to the scan.
    Either way the result has at most one row per calendar date."""
    src = weekly if every_date else weekly.where(F.col("symbol").isin(*names))
    return (src.groupBy("date")
                  .agg(*[F.max(F.when(F.col("symbol") == n, F.col("close")))
                         .alias(benchmark_column(n)) for n in names]))


def exclude_symbols(df: DataFrame, names: Sequence[str] = BENCHMARK_SYMBOLS) -> DataFrame:
    """``symbol NOT IN names``; a NULL symbol drops out too."""
    return df.where(~F.col("symbol").isin(*names))


def join_benchmarks(weekly: DataFrame, bench: DataFrame) -> DataFrame:
    """Left join on the exact bar date (J4). The benchmark side is grouped by
    date, so it holds at most one row of a few numbers per calendar date (a
    century is under 2 MB): it is broadcast, and the bars are not shuffled
    on their date."""
    return weekly.join(F.broadcast(bench), on="date", how="left")


def sma(n: int = SMA_LENGTH) -> Column:
    """Average close over the last ``n`` rows."""
    return F.avg("close").over(trailing(n))


def fill_count(n: int) -> Column:
    """Number of rows in the same frame."""
    return F.count(F.lit(1)).over(trailing(n))


def tp_sma(n: int = CCI_LENGTH) -> Column:
    """Average typical price over the last ``n`` rows."""
    return F.avg(typical_price()).over(trailing(n))


def trailing_high(n: int) -> Column:
    """Highest high of the previous ``n`` rows, current row excluded."""
    return F.max("high").over(symbol_window().rowsBetween(-n, -1))


def sma_value(avg: Column, count: Column, n: int = SMA_LENGTH,
              scale: int = SMA_SCALE) -> Column:
    """Rounded SMA when the frame is full, else NULL."""
    return F.when(count >= n, F.round(avg, scale))


def cci_value(tp: Column, tp_avg: Column, count: Column, n: int = CCI_LENGTH,
              scale: int = CCI_SCALE) -> Column:
    """I3, the simplified CCI: ``(tp - sma_tp) / (0.015 * sma_tp)``.

    The denominator is the SMA itself, not the mean absolute deviation."""
    den = F.lit(CCI_CONSTANT) * tp_avg
    return F.when((count >= n) & (tp_avg > 0),
                  F.round((tp - tp_avg) / F.nullif(den, F.lit(0.0)), scale))


def breakout_name(n: int) -> str:
    return f"is_breakout_{n}w"


def indicators(weekly: DataFrame, names: Sequence[str] = BENCHMARK_SYMBOLS,
               sma_n: int = SMA_LENGTH, cci_n: int = CCI_LENGTH,
               breakouts: Sequence[int] = BREAKOUT_WEEKS) -> DataFrame:
    """All per-bar indicator inputs, before guards and the warm-up filter."""
    bench = benchmarks(weekly, names, every_date=False)
    base = join_benchmarks(exclude_symbols(weekly, names), bench)
    cols = [F.col(c) for c in BAR_COLUMNS]
    cols += [sma(sma_n).alias("sma_raw"), fill_count(sma_n).alias("sma_count"),
             typical_price().alias("typical_price"), tp_sma(cci_n).alias("tp_sma"),
             fill_count(cci_n).alias("cci_count")]
    cols += [F.col(benchmark_column(n)) for n in names]
    cols += [guarded_ratio("close", benchmark_column(n), RS_SCALE)
             .alias(f"rs_{n.lower()}") for n in names]
    cols += [trailing_high(n).alias(f"prev_high_{n}w") for n in breakouts]
    ind = base.select(*cols)
    return ind.select("*", *[
        F.when(F.col("close") > F.col(f"prev_high_{n}w"), F.lit(1)).otherwise(F.lit(0))
         .alias(breakout_name(n)) for n in breakouts])


def warmup(df: DataFrame, count_col: str = "sma_count", n: int = SMA_LENGTH) -> DataFrame:
    """Keep bars whose SMA frame is full."""
    return df.where(F.col(count_col) >= n)


def weekly_technical_analysis(weekly: DataFrame,
                              names: Sequence[str] = BENCHMARK_SYMBOLS,
                              sma_n: int = SMA_LENGTH, cci_n: int = CCI_LENGTH,
                              breakouts: Sequence[int] = BREAKOUT_WEEKS) -> DataFrame:
    """The gold table (I6). Unsorted: sort only where a reader needs it."""
    ind = indicators(weekly, names, sma_n, cci_n, breakouts)
    out = [F.col(c) for c in BAR_COLUMNS]
    out.append(sma_value(F.col("sma_raw"), F.col("sma_count"), sma_n).alias(f"sma_{sma_n}"))
    out.append(cci_value(F.col("typical_price"), F.col("tp_sma"), F.col("cci_count"), cci_n)
               .alias(f"cci_{cci_n}"))
    out += [F.col(f"rs_{n.lower()}") for n in names]
    out += [F.col(breakout_name(n)) for n in breakouts]
    return warmup(ind, "sma_count", sma_n).select(*out)
