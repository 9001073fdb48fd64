"""Every registered query against its DuckDB twin on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from barforge import catalog, oracle
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v.isoformat() if hasattr(v, "isoformat") else v


def rows(cols, it):
    return sorted((tuple(norm(r[c]) for c in cols) for r in it), key=repr)


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert len(catalog.queries()) == 66
    assert set(catalog.queries()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    spark_rows = rows(cols, (r.asDict() for r in df.collect()))
    duck_rows = rows(cols, (dict(zip(rel.columns, r)) for r in rel.fetchall()))
    assert spark_rows == duck_rows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["date", "symbol"]
    assert df.count() == 2608  # gold rows at sf0.001


@pytest.mark.parametrize("name", ["weekly_technical_analysis", "incremental_run"])
def test_gate_scale_matches(spark, name):
    """The driver's gate runs at sf0.01: the flagship and the full run there."""
    sf = "/root/testdata/sf0.01"
    c = duckdb.connect()
    for t in ("lineitem", "supplier"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = E.queries()[name](spark, sf)
    rel = c.sql(E.oracle_sql()[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    assert rows(cols, (r.asDict() for r in df.collect())) == \
        rows(cols, (dict(zip(rel.columns, r)) for r in rel.fetchall()))
