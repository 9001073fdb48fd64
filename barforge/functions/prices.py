"""Price arithmetic with the guards the indicators need (ANSI-safe)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN -> NULL (P8). In Spark NaN passes ``IS NOT NULL`` and wins ``MAX``,
    while the columnar writer of the reference stores it as NULL."""
    c = _col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def typical_price(high="high", low="low", close="close") -> Column:
    """``(high + low + close) / 3.0``."""
    return (_col(high) + _col(low) + _col(close)) / F.lit(3.0)


def guarded_ratio(num, den, scale: int) -> Column:
    """``ROUND(num / den, scale)`` when ``den`` is non-NULL and positive, else
    NULL (I4). The guard sits outside the division, so ANSI mode never sees
    a zero divisor."""
    den = _col(den)
    return F.when(den.isNotNull() & (den > 0), F.round(_col(num) / den, scale))
