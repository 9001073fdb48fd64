import datetime as dt
import os

import pytest

from barforge.sources import storage
from barforge.sources.landing import normalize_landing, read_bronze, to_bronze
from barforge.sources.master import master_symbols, read_constituents, read_master, write_master
from conftest import D


def test_missing_optional_column_is_typed_null(spark):
    land = spark.createDataFrame(
        [(dt.datetime(2024, 3, 1), 1.0, 2.0, 0.5, 1.5, 10.9, 0.0, "A")],
        "Date timestamp, Open double, High double, Low double, Close double, Volume double, "
        "`Stock Splits` double, Symbol string")
    norm = normalize_landing(land, "UTC")
    assert "dividends" not in norm.columns  # tolerant projection skips it
    (r,) = to_bronze(norm).collect()
    assert r["dividends"] is None and r["volume"] == 10  # fraction truncated
    assert dict(to_bronze(norm).dtypes)["dividends"] == "double"


def test_exchange_time_zone_day(spark):
    land = spark.createDataFrame([(dt.datetime(2024, 3, 1, 18, 30, tzinfo=dt.timezone.utc),
                                   1.0, 1.0, 1.0, 1.0, 1.0, 0.0, 0.0, "A")],
                                 "Date timestamp, Open double, High double, Low double, "
                                 "Close double, Volume double, Dividends double, "
                                 "`Stock Splits` double, Symbol string")
    assert normalize_landing(land, "Asia/Kolkata").first()["date"] == D("2024-03-02")
    assert normalize_landing(land, "UTC").first()["date"] == D("2024-03-01")


def test_null_volume_raises(spark):
    land = spark.createDataFrame([(dt.datetime(2024, 3, 1), 1.0, 1.0, 1.0, 1.0, None, 0.0, 0.0, "A")],
                                 "Date timestamp, Open double, High double, Low double, "
                                 "Close double, Volume double, Dividends double, "
                                 "`Stock Splits` double, Symbol string")
    with pytest.raises(Exception):
        normalize_landing(land, "UTC").collect()
    assert normalize_landing(land, "UTC", strict_volume=False).first()["volume"] is None


def test_quoted_csv_and_folder_master(spark, scratch):
    d = os.path.join(scratch, "master_data")
    os.makedirs(d)
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write('Symbol,Company Name\nA.NS,"X, Ltd"\n')
    with open(os.path.join(d, "b.csv"), "w") as f:
        f.write('Symbol,Company Name\nB.NS,Y Corp\n')
    got = {r["symbol"]: r["company_name"] for r in read_master(spark, d).collect()}
    assert got == {"A.NS": "X, Ltd", "B.NS": "Y Corp"}


def test_master_missing_path_names_the_fix(spark, scratch):
    with pytest.raises(FileNotFoundError, match="write_master"):
        read_master(spark, f"{scratch}/nope.csv").collect()


def test_constituents_to_master_round_trip(spark, scratch):
    src = os.path.join(scratch, "list.csv")
    with open(src, "w") as f:
        f.write("Company Name,Industry,Symbol,Series\nAcme Ltd,Metals, ACME ,EQ\nBeta,IT,BETA,EQ\n")
    m = master_symbols(read_constituents(spark, src))
    assert sorted(m.collect()) == sorted([("ACME.NS", "Acme Ltd"), ("BETA.NS", "Beta")])
    write_master(m, f"{scratch}/out")
    assert sorted(read_master(spark, f"{scratch}/out").collect()) == sorted(m.collect())


def test_layer_namespace_rule(spark):
    assert storage.layer_name(None, "analytics") == "analytics"
    assert storage.layer_name("  nifty500_gold ", "analytics") == "nifty500_gold"


def test_verify_layers_and_stats(spark, scratch):
    from barforge.sources.landing import file_count, table_stats
    from barforge.schemas import BRONZE
    p = f"{scratch}/bronze"
    df = spark.createDataFrame([(D("2024-01-01"), 1.0, 1.0, 1.0, 1.0, 1, 0.0, 0.0, "A"),
                                (D("2024-01-03"), 1.0, 1.0, 1.0, 1.0, 1, 0.0, 0.0, "B")], BRONZE)
    df.coalesce(1).write.parquet(p)
    v = {r["name"]: r["exists"] for r in
         storage.verify_layers(spark, {"bronze": p, "gold": f"{scratch}/gold"}).collect()}
    assert v == {"bronze": True, "gold": False}
    s = table_stats(read_bronze(spark, p)).first()
    assert (s["row_count"], s["symbol_count"], s["min_date"], s["max_date"]) == \
        (2, 2, D("2024-01-01"), D("2024-01-03"))
    assert file_count(spark, p) == 1


def test_named_lazy_layers(spark):
    from barforge.operators.staging import stage_daily
    from barforge.sources import fixtures as fx
    from conftest import SF_SMALL
    register = storage.register_layer
    register(spark, fx.prices(spark, SF_SMALL), "ext_daily_prices")   # named source (S5)
    register(spark, stage_daily(spark.table("ext_daily_prices")), "stg_daily_prices")  # view (S10)
    n = spark.sql("SELECT COUNT(*) AS n FROM stg_daily_prices").first()["n"]
    assert n == stage_daily(fx.prices(spark, SF_SMALL)).count()
