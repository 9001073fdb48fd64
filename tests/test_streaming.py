import datetime as dt

from barforge.sources.landing import read_bronze
from barforge.streaming import start_landing_stream


def landing(spark, rows):
    return spark.createDataFrame(
        [(dt.datetime.fromisoformat(d), 1.0, 2.0, 0.5, c, v, 0.0, 0.0, s) for d, s, c, v in rows],
        "Date timestamp, Open double, High double, Low double, Close double, Volume double, "
        "Dividends double, `Stock Splits` double, Symbol string")


def test_file_stream_upserts_new_files_only(spark, scratch):
    land, bronze, ckpt = f"{scratch}/landing", f"{scratch}/bronze", f"{scratch}/ckpt"
    landing(spark, [("2024-03-07 00:00:00", "A", 1.0, 5.0),
                    ("2024-03-07 00:00:00", "A", 1.1, 9.0)]).write.mode("append").parquet(land)
    start_landing_stream(spark, land, bronze, ckpt, exchange_tz="UTC").awaitTermination(120)
    assert [(r["close"], r["volume"]) for r in read_bronze(spark, bronze).collect()] == [(1.1, 9)]
    # a later file re-sends the day with a bigger volume and adds a new day
    landing(spark, [("2024-03-07 00:00:00", "A", 1.2, 20.0),
                    ("2024-03-08 00:00:00", "A", 1.3, 4.0)]).write.mode("append").parquet(land)
    start_landing_stream(spark, land, bronze, ckpt, exchange_tz="UTC",
                         changes_path=f"{scratch}/changes").awaitTermination(120)
    from barforge.plans.changes import read_changes
    assert [tuple(r) for r in read_changes(spark, f"{scratch}/changes").symbols.collect()] == [("A", dt.date(2024, 3, 7))]
    got = sorted((r["date"].isoformat(), r["close"]) for r in read_bronze(spark, bronze).collect())
    assert got == [("2024-03-07", 1.2), ("2024-03-08", 1.3)]
