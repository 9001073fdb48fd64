"""Calendar keys. All stay ``DATE``; no session time zone is involved."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def week_key(date="date") -> Column:
    """Monday of the ISO week plus four days (F1).

    Saturday and Sunday belong to the Monday before them, so a weekend row
    joins the week that has just ended."""
    return F.date_add(F.trunc(_col(date), "week"), 4)


def month_key(date="date") -> Column:
    """Last day of the calendar month (F2)."""
    return F.last_day(_col(date))


def day_after(date) -> Column:
    """``date + 1 day``."""
    return F.date_add(_col(date), 1)


def lookback_start(run_date: dt.date | Column, months: int = 60) -> Column:
    """Start of a full load: ``run_date`` minus ``months`` (F12, "5y")."""
    d = run_date if isinstance(run_date, Column) else F.lit(run_date)
    return F.add_months(d, -months)


def to_trading_day(ts, field: T.DataType, exchange_tz: str | Column, session_tz: str) -> Column:
    """Calendar day of a landing timestamp on the exchange's wall clock.

    An instant (``TIMESTAMP``) is rendered in ``exchange_tz`` before taking
    the day; a wall-clock value (``TIMESTAMP_NTZ``, ``DATE``, text) is used
    as is. ``exchange_tz`` is a name or a column of names. Independent of the
    session time zone."""
    c = _col(ts)
    if isinstance(field, T.TimestampType):
        wall = F.convert_timezone(F.lit(session_tz), exchange_tz if isinstance(exchange_tz, Column) else F.lit(exchange_tz),
                                  c.cast(T.TimestampNTZType()))
        return F.to_date(wall)
    return F.to_date(c)


def wall_clock(ts: dt.datetime) -> Column:
    """A ``TIMESTAMP_NTZ`` literal with exactly this wall-clock value,
    whatever the session or Python time zone."""
    return F.to_timestamp_ntz(F.lit(ts.strftime("%Y-%m-%d %H:%M:%S")))


def utc_midnight(date="date") -> Column:
    """The instant (``TIMESTAMP``) at 00:00 UTC of a calendar day."""
    d = _col(date)
    return F.make_timestamp(F.year(d), F.month(d), F.dayofmonth(d),
                            F.lit(0), F.lit(0), F.lit(0), F.lit("UTC"))
