from barforge.__main__ import main
from barforge.sources import fixtures as fx, storage
from barforge.sources.master import write_master
from conftest import SF_SMALL


def test_cli_setup_daily_transform(spark, scratch, capsys):
    fx.landing(spark, SF_SMALL).write.parquet(f"{scratch}/landing")
    write_master(fx.master(spark, SF_SMALL), f"{scratch}/master")
    lake = f"{scratch}/lake"
    assert main(["setup", "--root", lake], spark=spark) == 0
    rc = main(["daily", "--root", lake, "--master", f"{scratch}/master",
               "--landing", f"{scratch}/landing", "--run-date", "2001-12-31",
               "--exchange-tz", "UTC", "--run-id", "cli1", "--layout", "day", "--symbol-buckets", "2"], spark=spark)
    assert rc == 0
    assert "symbols_ok" in capsys.readouterr().out
    assert main(["transform", "--root", lake], spark=spark) == 0
    assert {"day", "bucket"} <= set(storage.read_table(spark, f"{lake}/bronze").columns)
    assert storage.read_table(spark, f"{lake}/gold/weekly_technical_analysis").count() > 0


def test_cli_master(spark, scratch):
    import os
    from barforge.sources.master import read_master
    src = os.path.join(scratch, "list.csv")
    with open(src, "w") as f:
        f.write("Company Name,Industry,Symbol\nAcme Ltd,Metals, ACME \n")
    assert main(["master", "--constituents", src, "--out", f"{scratch}/m"], spark=spark) == 0
    assert [tuple(r) for r in read_master(spark, f"{scratch}/m").collect()] == [("ACME.NS", "Acme Ltd")]
