from barforge.operators import bars
from barforge.operators.indicators import weekly_technical_analysis
from barforge.operators.staging import stage_daily
from barforge.plans.transform import TransformPaths, read_bars, read_gold, run_transform
from barforge.sources import fixtures as fx
from conftest import SF_SMALL


def test_transform_writes_layers_equal_to_lazy_queries(spark, scratch):
    bronze = f"{scratch}/bronze"
    fx.prices(spark, SF_SMALL).write.parquet(bronze)
    paths = TransformPaths(silver=f"{scratch}/silver", gold=f"{scratch}/gold")
    report = run_transform(spark, bronze, paths)
    assert report.count() == 18 and report.where("violations > 0").count() == 0
    stg = stage_daily(fx.prices(spark, SF_SMALL))
    weekly = bars.resample_bars(stg, "week")
    for path, lazy in ((paths.weekly, weekly), (paths.monthly, bars.resample_bars(stg, "month")),
                       (paths.technical, weekly_technical_analysis(weekly))):
        stored = read_bars(spark, path) if "prices" in path else read_gold(spark, path)
        assert stored.columns == lazy.columns
        assert sorted(stored.collect()) == sorted(lazy.collect())
