import datetime as dt

from barforge.operators.indicators import weekly_technical_analysis
from barforge.schemas import BAR_COLUMNS, GOLD_COLUMNS


def weekly(spark, n, symbol="A", price=lambda i: 10.0 + i, start=dt.date(2020, 1, 3)):
    rows = [(start + dt.timedelta(weeks=i), symbol, price(i), price(i) * 1.1, price(i) * 0.9,
             price(i), 100) for i in range(n)]
    return spark.createDataFrame(rows, "date date, symbol string, open double, high double, "
                                       "low double, close double, volume bigint")


def test_gold_schema(spark):
    g = weekly_technical_analysis(weekly(spark, 31))
    assert g.columns == GOLD_COLUMNS
    assert g.columns[:7] == BAR_COLUMNS


def test_warmup_row_counts_and_cci(spark):
    assert weekly_technical_analysis(weekly(spark, 29)).count() == 0
    assert weekly_technical_analysis(weekly(spark, 30)).count() == 1
    g33 = weekly_technical_analysis(weekly(spark, 33)).collect()
    assert len(g33) == 4 and all(r["cci_34"] is None for r in g33)
    g34 = sorted(weekly_technical_analysis(weekly(spark, 34)).collect(), key=lambda r: r["date"])
    assert len(g34) == 5 and g34[-1]["cci_34"] is not None
    assert all(r["cci_34"] is None for r in g34[:-1])
    # simplified CCI uses the SMA of the typical price as denominator
    tps = [((10.0 + i) * 1.1 + (10.0 + i) * 0.9 + (10.0 + i)) / 3.0 for i in range(34)]
    m = sum(tps) / 34
    assert g34[-1]["cci_34"] == round((tps[-1] - m) / (0.015 * m), 2)
    assert g34[0]["sma_30"] == round(sum(10.0 + i for i in range(30)) / 30, 2)


def test_breakout_first_bar_and_equality(spark):
    # flat prices: close == previous high never breaks out
    flat = weekly(spark, 40, price=lambda i: 10.0)
    flat = flat.withColumn("high", flat["close"])
    assert all(r["is_breakout_13w"] == 0 for r in weekly_technical_analysis(flat).collect())
    # rising closes above every previous high -> breakout on each bar
    up = weekly(spark, 40, price=lambda i: 10.0 * (1.2 ** i))
    up = up.withColumn("high", up["close"])
    rows = weekly_technical_analysis(up).collect()
    assert all(r["is_breakout_104w"] == 1 for r in rows)


def test_benchmark_zero_or_missing_gives_null_rs(spark):
    stock = weekly(spark, 30)
    zero = weekly(spark, 15, symbol="NIFTY50", price=lambda i: 0.0)
    idx = weekly(spark, 30, symbol="NIFTY500", price=lambda i: 100.0).where("date > '2020-03-01'")
    g = weekly_technical_analysis(stock.unionByName(zero).unionByName(idx)).collect()
    assert len(g) == 1 and g[0]["symbol"] == "A"
    assert g[0]["rs_nifty50"] is None
    assert g[0]["rs_nifty500"] == round(g[0]["close"] / 100.0, 6)


def test_missing_benchmark_date_gives_null(spark):
    stock = weekly(spark, 30)
    idx = weekly(spark, 30, symbol="NIFTY500", price=lambda i: 100.0,
                 start=dt.date(2020, 1, 2))  # index bars end one day earlier
    (r,) = weekly_technical_analysis(stock.unionByName(idx)).collect()
    assert r["rs_nifty500"] is None


def test_zero_typical_price_no_division_error(spark):
    g = weekly_technical_analysis(weekly(spark, 34, price=lambda i: 0.0)).collect()
    assert len(g) == 5 and all(r["cci_34"] is None for r in g)
