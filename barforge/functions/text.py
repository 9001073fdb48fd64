"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_symbol(c, suffix: str = ".NS") -> Column:
    """``strip()`` of all white space, then append the exchange suffix."""
    return F.concat(F.regexp_replace(_col(c), r"^\s+|\s+$", ""), F.lit(suffix))


def bar_key(symbol="symbol", date="date") -> Column:
    """``symbol || '-' || date`` (F9). ``concat`` is NULL if any part is
    NULL, like ``||``; ``concat_ws`` would skip NULL parts instead."""
    return F.concat(_col(symbol), F.lit("-"), _col(date).cast("string"))
