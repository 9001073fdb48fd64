from barforge.operators import quality
from conftest import D


def test_checks_report_exactly_the_bad_rows(spark):
    df = spark.createDataFrame(
        [(D("2024-01-01"), "A", 1.0, 0), (D("2024-01-01"), "A", 2.0, 1),
         (None, "B", 3.0, 2), (D("2024-01-02"), None, None, None),
         (D("2024-01-03"), "C", 1.0, 5)],
        "date date, symbol string, close double, flag int")
    assert quality.check_not_null(df, "date").count() == 1
    assert quality.check_not_null(df, "close").count() == 1
    dup = quality.check_unique(df, quality.BAR_KEY_EXPR).collect()
    assert [r["unique_field"] for r in dup] == ["A-2024-01-01"]  # NULL keys ignored
    bad = sorted(r["value_field"] for r in quality.check_accepted_values(df, "flag", [0, 1]).collect())
    assert bad == [2, 5]
    rep = {(r["check"], r["column"]): r["violations"] for r in quality.layer_report(
        "t", df, ["date", "symbol", "close"], [quality.BAR_KEY_EXPR], {"flag": [0, 1]}).collect()}
    assert rep == {("not_null", "date"): 1, ("not_null", "symbol"): 1, ("not_null", "close"): 1,
                   ("unique", quality.BAR_KEY_EXPR): 1, ("accepted_values", "flag"): 2}
