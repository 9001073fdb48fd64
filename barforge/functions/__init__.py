"""Column-level helpers: every function returns a ``Column`` built from
``pyspark.sql.functions`` so it stays inside whole-stage codegen."""

from barforge.functions.dates import (day_after, lookback_start, month_key, to_trading_day,
                                      utc_midnight, wall_clock, week_key)
from barforge.functions.prices import guarded_ratio, nan_to_null, typical_price
from barforge.functions.text import bar_key, normalize_symbol

__all__ = [
    "bar_key", "day_after", "guarded_ratio", "lookback_start", "month_key",
    "nan_to_null", "normalize_symbol", "to_trading_day", "typical_price", "utc_midnight",
    "wall_clock", "week_key",
]
