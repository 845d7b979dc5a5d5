"""Data model of the price table ``bars``: one row per (symbol, trading day)."""

from __future__ import annotations

from pyspark.sql import types as T

SYMBOL = "symbol"
DATE = "Date"
PRICE_COLUMNS = ("Open", "High", "Low", "Close")
SPLITS = "Stock Splits"

# Layout of a price file (header order); the symbol comes from the file name.
CSV_SCHEMA = T.StructType(
    [
        T.StructField("Date", T.StringType(), True),
        T.StructField("Open", T.DoubleType(), True),
        T.StructField("High", T.DoubleType(), True),
        T.StructField("Low", T.DoubleType(), True),
        T.StructField("Close", T.DoubleType(), True),
        # Read as text and converted with try_cast: share counts are integers, but a
        # file may write them as "123.0".
        T.StructField("Volume", T.StringType(), True),
        T.StructField("Dividends", T.DoubleType(), True),
        T.StructField("Stock Splits", T.DoubleType(), True),
    ]
)

BARS_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType(), True),
        T.StructField("Date", T.DateType(), True),
        T.StructField("Open", T.DoubleType(), True),
        T.StructField("High", T.DoubleType(), True),
        T.StructField("Low", T.DoubleType(), True),
        T.StructField("Close", T.DoubleType(), True),
        T.StructField("Volume", T.LongType(), True),
        T.StructField("Dividends", T.DoubleType(), True),
        T.StructField("Stock Splits", T.DoubleType(), True),
    ]
)
BARS_COLUMNS = tuple(f.name for f in BARS_SCHEMA.fields)

# --- fixed values (must equal the original tool's) -------------------------------
# Period codes: w = week, m = month, y = year; d = day for the calendar operators.
CALENDAR_PERIODS = ("d", "w", "m", "y")
# Length in days of an anchored period.
ANCHORED_DAYS = {"w": 7, "m": 30, "y": 365}
# Title used in output column names.
PERIOD_TITLES = {"w": "Weekly", "m": "Monthly", "y": "Yearly"}
# Month abbreviations used in month labels (September is "Sept").
MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sept", "Oct", "Nov", "Dec")
# Row count shown at each end by the head-and-tail preview.
HEAD_TAIL_ROWS = 40
# Anchored monthly variation uses a fixed 30-day period.
MONTHLY_VARIATION_DAYS = 30
# ---------------------------------------------------------------------------------


def period_days(period: str) -> int:
    """Days in an anchored period ('w' 7, 'm' 30, 'y' 365)."""
    try:
        return ANCHORED_DAYS[period]
    except KeyError:
        raise ValueError(f"period must be one of {sorted(ANCHORED_DAYS)}, got {period!r}") from None


def period_title(period: str) -> str:
    """Column title of a period ('w' Weekly, 'm' Monthly, 'y' Yearly)."""
    try:
        return PERIOD_TITLES[period]
    except KeyError:
        raise ValueError(f"period must be one of {sorted(PERIOD_TITLES)}, got {period!r}") from None


def check_calendar_period(period: str, allowed: tuple[str, ...] = CALENDAR_PERIODS) -> str:
    if period not in allowed:
        raise ValueError(f"period must be one of {list(allowed)}, got {period!r}")
    return period
