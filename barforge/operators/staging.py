"""Staging: not-null filter and de-duplication of daily prices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.schemas import STAGING_COLUMNS

# The row kept per (symbol, date) is the one with the largest
# volume (NULL volume first, as on the reference's warehouse); remaining
# ties are broken on the other bronze columns, all DESC NULLS FIRST.
DEDUP_ORDER = ("volume", "close", "open", "high", "low", "dividends", "stock_splits")
REQUIRED = ("symbol", "date", "close")


def not_null(df: DataFrame, columns: Sequence[str] = REQUIRED) -> DataFrame:
    """Rows whose required columns are all non-NULL (P10)."""
    cond = None
    for c in columns:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.where(cond)


def dedup_order(order: Sequence[str] = DEDUP_ORDER) -> list[Column]:
    return [F.col(c).desc_nulls_first() for c in order]


def keep_first(df: DataFrame, keys: Sequence[str],
               order: Sequence[str] = DEDUP_ORDER) -> DataFrame:
    """One row per key: the first under ``order`` DESC NULLS FIRST.

    ``row_number() = 1`` is planned as a WindowGroupLimit on both sides of
    the shuffle, so at most one row per key and map task crosses the
    network: a key holding a third of all rows shrinks to one row per
    input split before it is exchanged."""
    w = Window.partitionBy(*keys).orderBy(*dedup_order(order))
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") == 1)
              .drop("_rn"))


def stage_daily(bronze: DataFrame) -> DataFrame:
    """The staging view: 9 columns, required columns non-NULL, one row per
    (symbol, date)."""
    src = not_null(bronze.select(*STAGING_COLUMNS))
    return keep_first(src, ["symbol", "date"]).select(*STAGING_COLUMNS)


def staging_sql(source: str) -> str:
    """The staging view as SQL text over a named table (S10): what
    ``stage_daily`` does, for ``storage.create_view``."""
    columns = ", ".join(STAGING_COLUMNS)
    given = " AND ".join(f"{c} IS NOT NULL" for c in REQUIRED)
    order = ", ".join(f"{c} DESC NULLS FIRST" for c in DEDUP_ORDER)
    return (f"SELECT {columns} FROM (SELECT {columns}, row_number() OVER (PARTITION BY symbol, date ORDER BY {order}) AS nth "
            f"FROM {source} WHERE {given}) WHERE nth = 1")
