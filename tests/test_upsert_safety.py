"""The stored upsert: what it reads, versions, two writers, null dates, unchanged rows, first empty run."""

import datetime as dt

import pytest

import barforge.plans.transform as T
from barforge.plans.changes import clear_changes, read_changes, record_changes
from barforge.plans.transform import TransformPaths, run_transform
from barforge.schemas import BRONZE
from barforge.sources import storage
from barforge.streaming import start_landing_stream
from conftest import D, bronze_rows

MONTHS = [f"2024-{m:02d}-05" for m in range(1, 13)]


@pytest.fixture()
def table(spark, scratch):
    path = f"{scratch}/bronze"
    rows = bronze_rows(spark, [(d, s, 1.0, 2.0, 0.5, 1.5, 10) for d in MONTHS for s in "AB"])
    storage.upsert_table(spark, rows, path, partitions=storage.month_partition())
    return path


def stored(spark, path):
    return sorted((str(r["date"]), r["symbol"], r["close"], r["volume"]) for r in storage.read_table(spark, path).collect())


def test_only_touched_months_are_read_and_written(spark, table):
    plan = storage.read_table(spark, table).where(storage.partition_filter(["month"], [(202403,)]))
    assert plan.inputFiles() and all("month=202403" in f for f in plan.inputFiles())
    before = set(storage.read_table(spark, table).inputFiles())
    storage.upsert_table(spark, bronze_rows(spark, [(MONTHS[2], "A", 1.0, 2.0, 0.5, 9.5, 11)]), table, partitions=storage.month_partition())
    after = set(storage.read_table(spark, table).inputFiles())
    assert {f for f in before if "month=202403" not in f} == {f for f in after if "month=202403" not in f}
    assert not {f for f in before & after if "month=202403" in f}
    rows = stored(spark, table)
    assert len(rows) == 24 and (MONTHS[2], "A", 9.5, 11) in rows


def test_unchanged_rows_change_nothing(spark, table):
    rows = bronze_rows(spark, [(d, "A", 1.0, 2.0, 0.5, 1.5, 10) for d in MONTHS] + [(MONTHS[11], "C", 1.0, 2.0, 0.5, 1.5, 1)])
    change = storage.plan_upsert(spark, rows, table, partitions=storage.month_partition())
    assert change.touched == [(202412,)] and change.earliest == D(MONTHS[11]) and change.rows.count() == 1
    storage.apply_upsert(spark, change)
    assert len(stored(spark, table)) == 25
    none = storage.plan_upsert(spark, rows, table, partitions=storage.month_partition())
    assert none.touched == [] and none.earliest is None


def test_a_write_that_is_cut_short_leaves_the_table(spark, table, monkeypatch):
    before = stored(spark, table)
    source = bronze_rows(spark, [(MONTHS[2], "A", 1.0, 2.0, 0.5, 9.5, 11)])
    real = storage.publish

    def cut(spark, version):
        raise RuntimeError("lost")

    monkeypatch.setattr(storage, "publish", cut)
    with pytest.raises(RuntimeError):
        storage.upsert_table(spark, source, table, partitions=storage.month_partition())
    assert stored(spark, table) == before
    monkeypatch.setattr(storage, "publish", real)
    storage.upsert_table(spark, source, table, partitions=storage.month_partition())
    assert len(stored(spark, table)) == 24 and (MONTHS[2], "A", 9.5, 11) in stored(spark, table)


def test_two_writers_of_one_month_lose_nothing(spark, table):
    """The second publishes between the plan of the first and its publication."""
    one = storage.plan_upsert(spark, bronze_rows(spark, [(MONTHS[2], "X", 1.0, 2.0, 0.5, 3.5, 1)]), table, partitions=storage.month_partition())
    storage.upsert_table(spark, bronze_rows(spark, [(MONTHS[2], "Y", 1.0, 2.0, 0.5, 4.5, 2), (MONTHS[5], "Y", 1.0, 2.0, 0.5, 4.5, 2)]),
                         table, partitions=storage.month_partition())
    seen = []
    storage.apply_upsert(spark, one, before_publish=lambda c: seen.append(c.touched))
    rows = stored(spark, table)
    assert len(rows) == 27 and {(MONTHS[2], "X", 3.5, 1), (MONTHS[2], "Y", 4.5, 2)} <= set(rows) and seen == [[(202403,)]]
    # A writer that is overtaken every time gives up without a change.
    two = storage.plan_upsert(spark, bronze_rows(spark, [(MONTHS[2], "Z", 1.0, 2.0, 0.5, 3.5, 1)]), table, partitions=storage.month_partition())
    storage.upsert_table(spark, bronze_rows(spark, [(MONTHS[2], "Y", 1.0, 2.0, 0.5, 5.5, 2)]), table, partitions=storage.month_partition())
    with pytest.raises(storage.TableChanged):
        storage.apply_upsert(spark, two, attempts=1)
    assert not [r for r in stored(spark, table) if r[1] == "Z"]


def test_rows_without_a_date_stay(spark, table):
    def undated(symbol):
        return spark.createDataFrame([(None, 1.0, 1.0, 1.0, 1.0, 1, 0.0, 0.0, symbol)], BRONZE)

    for symbol in "XY":
        storage.upsert_table(spark, undated(symbol), table, partitions=storage.month_partition())
    rows = storage.read_table(spark, table)
    assert sorted(r["symbol"] for r in rows.where("date is null").collect()) == ["X", "Y"] and rows.count() == 26


def test_unused_versions_are_removed_late(spark, table):
    storage.upsert_table(spark, bronze_rows(spark, [(MONTHS[2], "A", 1.0, 2.0, 0.5, 9.5, 11)]), table, partitions=storage.month_partition())
    rows = storage.read_table(spark, table)
    lost = storage.write_version(rows, table, storage.month_partition())   # never published
    assert storage.remove_unused(spark, table) == []    # too young
    gone = storage.remove_unused(spark, table, dt.timedelta(seconds=-5))
    assert [g.rsplit("/", 1)[1] for g in gone] == [lost.folder.rsplit("/", 1)[1]] and len(stored(spark, table)) == 24


def test_version_figures_are_counted_while_written(spark, scratch):
    rows = bronze_rows(spark, [(d, "A", 1.0, 2.0, 0.5, None, 10) for d in MONTHS[:3]] + [(MONTHS[0], None, 1.0, 1.0, 1.0, 1.0, 1)])
    version = storage.write_version(rows, f"{scratch}/t", storage.month_partition())
    assert version.figures["rows"] == 4 and version.figures["null close"] == 3 and version.figures["null symbol"] == 1
    assert sorted(version.values) == [(202401,), (202402,), (202403,)] and not storage.table_exists(spark, f"{scratch}/t")
    empty = storage.write_version(spark.createDataFrame([], BRONZE), f"{scratch}/e", storage.month_partition())
    assert empty.figures["rows"] == 0 and storage.publish(spark, empty).count() == 0


def test_change_set_keeps_loads_that_were_not_read(spark, scratch):
    path = f"{scratch}/changes"
    record_changes(spark, path, bronze_rows(spark, [("2024-03-01", "A", 1.0, 1.0, 1.0, 1.0, 1), ("2024-03-09", "B", 1.0, 1.0, 1.0, 1.0, 1)]), "r 1")
    read = read_changes(spark, path)
    record_changes(spark, path, bronze_rows(spark, [("2024-02-01", "A", 1.0, 1.0, 1.0, 1.0, 1)]), "r 1")
    assert sorted(map(tuple, read_changes(spark, path).symbols.collect())) == [("A", D("2024-02-01")), ("B", D("2024-03-09"))]
    clear_changes(spark, path, read.loads)
    assert sorted(map(tuple, read_changes(spark, path).symbols.collect())) == [("A", D("2024-02-01"))]
    clear_changes(spark, path, read_changes(spark, path).loads)
    assert read_changes(spark, path).symbols.isEmpty()


def test_failed_check_publishes_nothing(spark, scratch, monkeypatch):
    paths, changes = TransformPaths(silver=f"{scratch}/silver", gold=f"{scratch}/gold"), f"{scratch}/changes"
    assert run_transform(spark, f"{scratch}/bronze", paths, changes_path=changes).collect() == []

    def load(days, close):
        rows = bronze_rows(spark, [(d, "A", 1.0, 2.0, 0.5, close, 10) for d in days])
        storage.apply_upsert(spark, storage.plan_upsert(spark, rows, f"{scratch}/bronze", partitions=storage.month_partition()),
                             before_publish=lambda c: record_changes(spark, changes, c.rows, "r"))

    load(MONTHS, 1.5)
    bad = spark.createDataFrame([("l", "not_null", "c", 1)], "layer string, check string, column string, violations bigint")
    real = T.quality.quality_report
    monkeypatch.setattr(T.quality, "quality_report", lambda *a, **k: bad)
    run_transform(spark, f"{scratch}/bronze", paths, changes_path=changes)
    assert not storage.table_exists(spark, paths.weekly) and read_changes(spark, changes).loads
    monkeypatch.setattr(T.quality, "quality_report", real)
    assert run_transform(spark, f"{scratch}/bronze", paths, changes_path=changes).where("violations > 0").count() == 0
    assert not read_changes(spark, changes).loads
    before = sorted(T.read_bars(spark, paths.weekly).collect())

    # A rebuild: a reader sees the old table all through it, also while the checks run.
    load(MONTHS[:1], 7.5)
    during = []

    def watched(*a, **k):
        during.append(sorted(T.read_bars(spark.newSession(), paths.weekly).collect()))
        return real(*a, **k)

    monkeypatch.setattr(T.quality, "quality_report", lambda *a, **k: bad)
    run_transform(spark, f"{scratch}/bronze", paths, changes_path=changes, full=True)
    assert sorted(T.read_bars(spark, paths.weekly).collect()) == before
    monkeypatch.setattr(T.quality, "quality_report", watched)
    run_transform(spark, f"{scratch}/bronze", paths, changes_path=changes, full=True)
    after = sorted(T.read_bars(spark, paths.weekly).collect())
    assert during == [before] and after != before and not read_changes(spark, changes).loads


def test_stream_restarts_where_it_stopped(spark, scratch):
    land, bronze = f"{scratch}/landing", f"{scratch}/bronze"
    one = spark.createDataFrame([(dt.datetime(2024, 3, 7), 1.0, 2.0, 0.5, 1.0, 5.0, 0.0, 0.0, "A")],
                                "Date timestamp, Open double, High double, Low double, Close double, Volume double, "
                                "Dividends double, `Stock Splits` double, Symbol string")
    one.write.mode("append").parquet(land)
    for _ in range(2):
        q = start_landing_stream(spark, land, bronze, exchange_tz="UTC")
        q.awaitTermination(120)
    assert storage.path_exists(spark, f"{bronze}__stream") and q.lastProgress is None or q.lastProgress["numInputRows"] == 0
