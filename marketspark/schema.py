"""Table schemas and the fixed tables of names, durations and codes."""

from __future__ import annotations

from pyspark.sql import types as T

TICK_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("bid", T.DoubleType()),
    T.StructField("ask", T.DoubleType()),
    T.StructField("bid_volume", T.DoubleType()),
    T.StructField("ask_volume", T.DoubleType()),
    T.StructField("seq", T.LongType()),
])

BAR_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("tick_count", T.IntegerType()),
])

TRADE_COLUMNS = (
    "entry_time", "exit_time", "signal", "entry_price", "exit_price",
    "bars_held", "pnl_r", "reason", "weekday", "hour",
)

# Supported timeframes and their length in seconds.
TIMEFRAME_SECONDS = {
    "1m": 60,
    "5m": 300,
    "15m": 900,
    "30m": 1800,
    "1H": 3600,
    "2H": 7200,
    "4H": 14400,
    "1D": 86400,
    "1W": 604800,
}

# Calendar unit behind each pivot anchor.
ANCHOR_UNITS = {
    "daily": "day",
    "weekly": "week",
    "monthly": "month",
    "quarterly": "quarter",
    "yearly": "year",
}

# Session windows in New York time, minutes after midnight, half open.
SESSIONS = {
    "asia": (20 * 60, 24 * 60),
    "london": (2 * 60, 5 * 60),
    "nyam": (9 * 60 + 30, 11 * 60),
    "nylunch": (12 * 60, 13 * 60),
    "nypm": (13 * 60 + 30, 16 * 60),
}

# Ordinal classes of a label.
LABEL_CLASSES = (-2, -1, 0, 1, 2)
LABEL_HORIZONS = (5, 10, 20)

# Columns that are never model inputs (label and look-ahead
# columns of any horizon are excluded by prefix in addition).
NON_FEATURE_COLUMNS = ("timestamp", "open", "high", "low", "close", "tick_count")
NON_FEATURE_PREFIXES = ("label_", "close_ahead_")


def timeframe_seconds(timeframe: str) -> int:
    try:
        return TIMEFRAME_SECONDS[timeframe]
    except KeyError:
        raise ValueError(
            f"unknown timeframe {timeframe!r}; choose from {sorted(TIMEFRAME_SECONDS)}"
        ) from None
