"""Calendar-period analytics: averages, variations, returns and return rates per symbol.

Calendar periods group days by (ISO week number, calendar year), (month, year) or year. Operators that
work on one row per period use the period's *representative bar*: its latest day, with that day's
Open and Close (``max_by`` on the date, a deterministic aggregate with partial aggregation, so one
shuffle on (symbol, period) carries at most one row per period and map task). Windows run per symbol
over those period rows, ordered by date.

Every operator is lazy and answers all symbols in one plan; sort at the edge if an order is wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candela.functions.columns import calendar_keys, pct, position_return_rate
from candela.operators.positions import with_neighbours
from candela.schema import check_calendar_period, period_title

def by_date() -> Window:
    """Per-symbol window in date order."""
    return Window.partitionBy("symbol").orderBy("Date")


# Suffix of the shifted-period column names: Close(W+1), Open(M+1), ...
_SHIFT_NAME = {"w": "W+1", "m": "M+1", "y": "Y+1"}


def dated(bars: DataFrame) -> DataFrame:
    """Rows with a usable date: a row without one is no period's representative bar and no anchor."""
    return bars.where(F.col("Date").isNotNull())


def between_dates(bars: DataFrame, on, until) -> DataFrame:
    """Rows with ``on <= Date <= until`` (both inclusive); pushed to the Parquet scan when possible."""
    return bars.where(F.col("Date").between(_date(on), _date(until)))


def _date(value) -> Column:
    return value if isinstance(value, Column) else F.to_date(F.lit(str(value)))


def last_bar(
    bars: DataFrame, period: str, columns=("Open", "Close"), year_name: str = "year_nb", iso_year: bool = False
) -> DataFrame:
    """Representative bar of each (symbol, calendar period): the period's latest day and its values.

    ``iso_year=True`` pairs ISO weeks with the ISO week-numbering year instead of the calendar year."""
    keys = calendar_keys(period, year_name=year_name, iso_year=iso_year)
    values = [F.max_by(c, "Date").alias(c) for c in columns]
    return dated(bars).groupBy("symbol", *keys).agg(F.max("Date").alias("Date"), *values)


# A1
def avg_price_until(bars: DataFrame, on, until, field: str = "Open", every_symbol: bool = False) -> DataFrame:
    """Mean of ``field`` over ``on <= Date <= until``, per symbol: ``Average_{field}_Price_($)``. A symbol with no
    row in the range has no row, or with ``every_symbol`` a null; that reads the rows outside the range too."""
    if every_symbol:
        inside = F.when(F.col("Date").between(_date(on), _date(until)), F.col(field))
        return bars.groupBy("symbol").agg(F.avg(inside).alias(f"Average_{field}_Price_($)"))
    return (
        between_dates(bars, on, until)
        .groupBy("symbol")
        .agg(F.avg(field).alias(f"Average_{field}_Price_($)"))
    )


# A2
def avg_price_period(bars: DataFrame, period: str, field: str = "Open", iso_year: bool = False) -> DataFrame:
    """Mean of ``field`` per symbol and calendar week / month / year: ``Average_Price`` (null -> 0).
    Rows without a date are a group of their own, whose keys become 0 as every null number does."""
    check_calendar_period(period, ("w", "m", "y"))
    keys = calendar_keys(period, year_name="year", iso_year=iso_year)
    return (
        bars.groupBy("symbol", *keys)
        .agg(F.avg(field).alias("Average_Price"))
        .fillna(0)
    )


# A3
def stock_variation(bars: DataFrame, period: str = "d", iso_year: bool = False) -> DataFrame:
    """Change of the Open price against the previous day ('d') or previous period's representative bar.

    Output ``symbol, Date, Variation_Open_Price``; the first row of each symbol gets 0.
    'w' is an extension (same rule on weekly representative bars). Rows without a date come first; with 'd',
    rows of one date are in the order of their Open, and a symbol is worked on in blocks of rows.
    """
    check_calendar_period(period)
    if period == "d":
        change = lambda w: {"Variation_Open_Price": F.col("Open") - F.lag("Open").over(w)}
        return with_neighbours(bars.select("symbol", "Date", "Open"), change, behind=1).drop("Open").fillna(0)
    rows = last_bar(bars, period, ("Open",), iso_year=iso_year)
    variation = (F.col("Open") - F.lag("Open").over(by_date())).alias("Variation_Open_Price")
    return rows.select("symbol", "Date", variation).fillna(0)


# A4
def stock_variation_until(bars: DataFrame, on, until, period: str = "d", iso_year: bool = False) -> DataFrame:
    """``stock_variation`` of the rows in ``[on, until]``; the filter runs before the window."""
    return stock_variation(between_dates(bars, on, until), period, iso_year)


# A6
def period_return(bars: DataFrame, period: str = "d", iso_year: bool = False) -> DataFrame:
    """Return from a period's Open to the next period's Close.

    'd': every column plus ``Daily_Return = pct(Open, Close)``.
    'w'/'m'/'y': ``symbol, Date, Open, Close(X+1), Benefit`` on representative bars, where ``Close(X+1)``
    is the next period's Close and ``Benefit = pct(Open, Close(X+1))``; the newest period gets 0.
    Nulls become 0.
    """
    check_calendar_period(period)
    if period == "d":
        return bars.withColumn("Daily_Return", pct("Open", "Close")).fillna(0)
    nxt = f"Close({_SHIFT_NAME[period]})"
    rows = last_bar(bars, period, ("Open", "Close"), iso_year=iso_year)
    with_next = rows.select("symbol", "Date", "Open", F.lead("Close").over(by_date()).alias(nxt))
    return with_next.withColumn("Benefit", pct("Open", nxt)).fillna(0)


# A7
def period_return_until(bars: DataFrame, on, until, period: str = "d", iso_year: bool = False) -> DataFrame:
    """``period_return`` of the rows in ``[on, until]``."""
    return period_return(between_dates(bars, on, until), period, iso_year)


# A8
def avg_return(bars: DataFrame, period: str, iso_year: bool = False) -> DataFrame:
    """Mean daily return per calendar week / month / year: ``Weekly_Return`` / ``Monthly_Return`` /
    ``Yearly_Return``. Daily returns that are null are counted as 0 before averaging."""
    check_calendar_period(period, ("w", "m", "y"))
    daily = period_return(bars, "d")
    keys = calendar_keys(period, year_name="year_nb", iso_year=iso_year)
    return (
        daily.groupBy("symbol", *keys)
        .agg(F.avg("Daily_Return").alias(f"{period_title(period)}_Return"))
        .fillna(0)
    )


# A9
def moving_average(bars: DataFrame, field: str = "Open", n: int = 5) -> DataFrame:
    """Every column plus ``Moving_Average``: mean of ``field`` over the current row and the ``n - 1``
    following rows of the symbol (a forward frame, shorter at the end). Nulls become 0; rows without
    a date come first, rows of one date in the order of their values. Symbols are worked on in blocks of rows."""
    if n < 1:
        raise ValueError("n must be >= 1")
    mean = lambda w: {"Moving_Average": F.avg(field).over(w.rowsBetween(0, n - 1))}
    return with_neighbours(bars, mean, ahead=n - 1).fillna(0)


# A11
def return_rate(bars: DataFrame, on, until, shares: float) -> DataFrame:
    """Rows in ``[on, until]`` plus ``Return_Rate(%)`` of a position of ``shares`` from Open to Close."""
    return between_dates(bars, on, until).withColumn(
        "Return_Rate(%)", position_return_rate("Open", "Close", shares)
    )


# A13 / N12
def dividend_return(bars: DataFrame, shares: float, output_col: str = "Revenues") -> DataFrame:
    """Every column plus the dividend revenue of ``shares`` shares (``Dividends * shares``)."""
    return bars.withColumn(output_col, F.col("Dividends") * F.lit(shares))


# A14
def max_return(bars: DataFrame, period: str, iso_year: bool = False) -> DataFrame:
    """Largest ``Benefit`` of ``period_return`` per symbol as ``Max_Return`` ('d': largest daily return)."""
    value = "Daily_Return" if period == "d" else "Benefit"
    return period_return(bars, period, iso_year).groupBy("symbol").agg(F.max(value).alias("Max_Return"))


# A16
def return_rate_period(bars: DataFrame, period: str, shares: float, iso_year: bool = False) -> DataFrame:
    """Return rate of a position of ``shares`` per period.

    'd': every column plus ``Return_Rate(%)`` from Open to Close.
    'w': ``symbol, Date, Open, Open(W+1), Return_Rate(%)`` on representative bars;
    'm': ``symbol, Date, month_nb, Open, Open(M+1), Return_Rate(%)``;
    'y': ``symbol, Date, year_nb, Open, Open(Y+1), Return_Rate(%)``.
    ``Open(X+1)`` holds the *previous* period's Open (the name is kept from the original tool). For 'w'
    and 'm' the rate goes from this period's Open to ``Open(X+1)``; for 'y' from Open to this period's
    Close. Nulls become 0.
    """
    check_calendar_period(period)
    if period == "d":
        return bars.withColumn("Return_Rate(%)", position_return_rate("Open", "Close", shares)).fillna(0)
    shifted = f"Open({_SHIFT_NAME[period]})"
    rows = last_bar(bars, period, ("Open", "Close"), iso_year=iso_year)
    rows = rows.withColumn(shifted, F.lag("Open").over(by_date()))
    target = "Close" if period == "y" else shifted
    rows = rows.withColumn("Return_Rate(%)", position_return_rate("Open", target, shares))
    key = {"w": [], "m": ["month_nb"], "y": ["year_nb"]}[period]
    return rows.select("symbol", "Date", *key, "Open", shifted, "Return_Rate(%)").fillna(0)


# A15
def max_return_rate(bars: DataFrame, period: str, shares: float, iso_year: bool = False) -> DataFrame:
    """Largest ``Return_Rate(%)`` of ``return_rate_period`` per symbol as ``Max_Return_Rate``."""
    return (
        return_rate_period(bars, period, shares, iso_year)
        .groupBy("symbol")
        .agg(F.max("Return_Rate(%)").alias("Max_Return_Rate"))
    )
