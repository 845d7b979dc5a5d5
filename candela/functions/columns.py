"""Column expressions: percent change, return rate, calendar keys, labels, rounding; the order of a result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.schema import DATE, MONTH_NAMES, check_calendar_period


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pct(initial, current) -> Column:
    """Percent change ``(current - initial) / initial * 100``; null when ``initial`` is 0 or null."""
    i, c = _c(initial), _c(current)
    return F.try_divide(c - i, i) * F.lit(100.0)


def position_return_rate(open_price, final_price, shares) -> Column:
    """Return rate in percent of a position of ``shares`` bought at ``open_price`` and valued at ``final_price``.

    The share count cancels out except for rounding and for ``shares == 0`` (null).
    """
    n = F.lit(shares) if not isinstance(shares, Column) else shares
    return pct(_c(open_price) * n, _c(final_price) * n)


def calendar_keys(period: str, date=DATE, year_name: str = "year_nb", iso_year: bool = False) -> list[Column]:
    """Grouping keys of a calendar period.

    'w' -> (week_nb, year), 'm' -> (month_nb, year), 'y' -> (year,). The week is the ISO week number;
    by default it is paired with the *calendar* year, so 2019-12-30 (ISO week 1) falls into week 1 of
    2019. ``iso_year=True`` pairs it with the ISO week-numbering year instead.
    """
    check_calendar_period(period, ("w", "m", "y"))
    d = _c(date)
    year = F.extract(F.lit("YEAROFWEEK"), d) if (iso_year and period == "w") else F.year(d)
    year = year.alias(year_name)
    if period == "w":
        return [F.weekofyear(d).alias("week_nb"), year]
    if period == "m":
        return [F.month(d).alias("month_nb"), year]
    return [year]


def month_label(month, year) -> Column:
    """``"Jan-2024"`` style label; null when the month is outside 1..12."""
    m, y = _c(month), _c(year)
    names = F.array(*[F.lit(n) for n in MONTH_NAMES])
    name = F.when(m.between(1, 12), F.element_at(names, m.cast("int")))
    return F.concat(name, F.lit("-"), y.cast("string"))


def round_to(x, digits: int | None) -> Column:
    """Round half-to-even (like numpy's ``round``) to ``digits`` decimals; ``None`` keeps the value."""
    col = _c(x)
    return col if digits is None else F.bround(col, digits)


def pearson(x, y) -> Column:
    """Pearson correlation aggregate over the rows where both values are present.

    Built from ``covar_samp`` and ``stddev_samp`` so that a constant series gives NaN (as
    ``DataFrame.stat.corr`` does) instead of a division-by-zero error under ANSI mode; fewer than two
    rows give null.
    """
    x, y = _c(x), _c(y)
    xs, ys = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    spread = F.stddev_samp(xs) * F.stddev_samp(ys)
    return F.when(spread == 0, F.lit(float("nan"))).otherwise(F.try_divide(F.covar_samp(xs, ys), spread))


def newest_first(df: DataFrame) -> DataFrame:
    """``df`` by symbol, the newest day or period first (rows without one last). Operators do not sort; this is for the edge."""
    order = [c for c in ("Date", "year_nb", "year", "month_nb", "week_nb", "Period") if c in df.columns]
    if not order:
        raise ValueError("no column of days or periods to sort by")
    return df.orderBy("symbol", *[F.col(c).desc() for c in order])
