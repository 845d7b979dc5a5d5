"""Checked queries: each key binds an operator to fixed parameters over the price bars derived from the
``orders`` / ``lineitem`` tables, and has an equivalent SQL text (DuckDB dialect) over the same tables.

Bindings: symbols are the order priorities; range 1996-01-01 .. 1998-12-31; windows of 5 rows; positions
of 200 shares; dividends for 10 shares. Double outputs are rounded to 6 decimals on both sides so the
two engines' last-bit differences do not matter; operators that round themselves are run unrounded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela import operators as ops
from candela.functions import newest_first
from candela.plans.registry import run, run_many
from candela.schema import BARS_COLUMNS
from candela.session import shared_path
from candela.sources import line_counts, read_bars, read_bars_csv, typed_bars, write_bars, write_bars_csv
from candela.sources.tables import load_bars

ON, UNTIL = "1996-01-01", "1998-12-31"
#: A day on which some symbols of the smaller tables have no bar.
ONE_DAY = "1996-03-06"
SHARES = 200
DIVIDEND_SHARES = 10
WINDOW = 5
SYMBOL_1, SYMBOL_2 = "1-URGENT", "2-HIGH"
DIGITS = 6


def round_exact(name: str, digits: int = DIGITS) -> str:
    """SQL that rounds column ``name`` half away from zero to ``digits`` decimals in exact decimal arithmetic, after
    absorbing floating-point noise at 9 decimals: two engines that sum in different orders then agree, also on
    exact ties such as an average of 2-decimal prices over 32 rows. NaN, infinities
    and values beyond the exact range pass through."""
    rounded = f"cast(round(try_cast({name} as decimal(38,9)), {digits}) as double)"
    return f"if(isnan({name}) or abs({name}) = double('infinity'), {name}, coalesce({rounded}, {name}))"


def finish(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column to ``digits`` decimals (presentation for the cross-engine check)."""
    names = {f.name: f"`{f.name}`" for f in df.schema.fields}
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    return df.selectExpr(*[f"{round_exact(q, digits)} as {q}" if n in doubles else q for n, q in names.items()])


Loader = Callable[..., DataFrame]


def spark_queries(load: Loader = load_bars) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The checked queries. ``load(spark, sf_dir, on, until)`` provides ``bars``, of a range of days if given:
    by default derived from the tables; the benchmark passes a loader of bars stored once."""

    def _q(build: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finish(build(load(spark, sf_dir)))

        return query

    def _until(build: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finish(build(load(spark, sf_dir, ON, UNTIL)))

        return query

    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    q["scan_bars"] = _q(lambda b: b)
    for p in "dwmy":
        q[f"max_return_rate_{p}"] = _q(lambda b, p=p: ops.max_return_rate(b, p, SHARES))
        q[f"return_rate_period_{p}"] = _q(lambda b, p=p: ops.return_rate_period(b, p, SHARES))
        q[f"stock_variation_{p}"] = _q(lambda b, p=p: ops.stock_variation(b, p))
        q[f"period_return_{p}"] = _q(lambda b, p=p: ops.period_return(b, p))
        q[f"max_return_{p}"] = _q(lambda b, p=p: ops.max_return(b, p))
    q["return_rate_until"] = _until(lambda b: ops.return_rate(b, ON, UNTIL, SHARES))
    q["avg_price_until"] = _until(lambda b: ops.avg_price_until(b, ON, UNTIL, "Open"))
    q["avg_price_until_every"] = _q(lambda b: ops.avg_price_until(b, ONE_DAY, ONE_DAY, "Open", every_symbol=True))
    q["stock_variation_until_m"] = _until(lambda b: ops.stock_variation_until(b, ON, UNTIL, "m"))
    q["period_return_until_m"] = _until(lambda b: ops.period_return_until(b, ON, UNTIL, "m"))
    for p in "wmy":
        q[f"avg_price_{p}"] = _q(lambda b, p=p: ops.avg_price_period(b, p, "Open"))
        q[f"avg_return_{p}"] = _q(lambda b, p=p: ops.avg_return(b, p))
        q[f"anchored_avg_price_{p}"] = _q(lambda b, p=p: ops.anchored_avg_price(b, p, "Open", digits=None))
        q[f"anchored_avg_return_{p}"] = _q(lambda b, p=p: ops.anchored_avg_return(b, p, digits=None))
        q[f"anchored_return_rate_{p}"] = _q(lambda b, p=p: ops.anchored_return_rate(b, p))
        q[f"anchored_max_return_rate_{p}"] = _q(lambda b, p=p: ops.anchored_max_return_rate(b, p))
        q[f"anchored_volume_variation_{p}"] = _q(lambda b, p=p: ops.anchored_volume_variation(b, p))
    q["moving_average_5"] = _q(lambda b: ops.moving_average(b, "Open", WINDOW))
    q["correlation_pair"] = _q(lambda b: ops.correlation_between(b, [(SYMBOL_1, SYMBOL_2)], "Open", "Close"))
    q["correlation_matrix"] = _q(lambda b: ops.correlation_matrix(b, SYMBOL_1, SYMBOL_2, "Open"))
    q["dividend_return"] = _q(lambda b: ops.dividend_return(b, DIVIDEND_SHARES))
    q["dividend_revenus"] = _q(lambda b: ops.dividend_return(b, DIVIDEND_SHARES, output_col="Revenus"))
    q["anchored_avg_close_m"] = _q(lambda b: ops.anchored_avg_price(b, "m", "Close", digits=None))
    q["correlation_pair_by_date"] = _q(
        lambda b: ops.correlation_between(b, [(SYMBOL_1, SYMBOL_2)], "Open", "Close", on="date")
    )
    q["head_tail_40"] = _q(lambda b: ops.head_and_tail(b, 40))
    q["num_observations"] = _q(ops.num_observations)
    q["date_span"] = _q(ops.date_span)
    q["most_common_day"] = _q(ops.most_common_day)
    q["descriptive_stats"] = _q(ops.descriptive_stats)
    q["missing_counts"] = _q(ops.missing_counts)
    q["column_correlation"] = _q(lambda b: ops.column_correlation(b, "Open", "Close"))
    q["sampling_frequency"] = _q(ops.sampling_frequency)
    q["anchored_monthly_variation"] = _q(lambda b: ops.anchored_monthly_variation(b, digits=None))
    q["anchored_monthly_variation_first3"] = _q(lambda b: ops.anchored_monthly_variation(b, 3, digits=None))
    q["intraday_variation"] = _q(lambda b: ops.intraday_variation(b, digits=None))
    q["max_daily_return"] = _q(lambda b: ops.max_daily_return(b, digits=None))
    q["latest_average"] = _q(lambda b: ops.latest_average(b, "Open", WINDOW, digits=None))
    q["month_label"] = _q(ops.with_month_label)
    q["csv_parse"] = _q(lambda b: typed_bars(as_text(b)))
    q["run_dispatch"] = _q(lambda b: run(b, "return_rate_period", symbols=[SYMBOL_1, SYMBOL_2], period="y", shares=SHARES))
    q["avg_price_m_newest"] = lambda spark, sf_dir: newest_first(finish(ops.avg_price_period(load(spark, sf_dir), "m", "Open")))
    q["intraday_variation_rounded"] = _q(ops.intraday_variation)
    q["anchored_avg_price_rounded"] = _q(lambda b: ops.anchored_avg_price(b.withColumn("Open", F.expr("floor(Open)")), "m"))
    q["run_many"] = _q(
        lambda b: run_many(b, [*SUMMARIES, ("column_correlation", {"col1": "Open", "col2": "Close"})]).select("symbol", *[f"{s}.*" for s in SUMMARIES], "column_correlation.*")
    )
    q["csv_files"] = _q(through_files)
    q["csv_line_counts"] = _q(through_dirty_files)
    q["return_rate_until_by_year"] = _q(lambda b: ops.return_rate(through_years(b), ON, UNTIL, SHARES))
    gaps = {
        "missing_counts": ops.missing_counts,
        "period_return_d": lambda b: ops.period_return(b, "d"),
        "period_return_m": lambda b: ops.period_return(b, "m"),
        "return_rate_period_d": lambda b: ops.return_rate_period(b, "d", SHARES),
        "return_rate_until": lambda b: ops.return_rate(b, ON, UNTIL, SHARES),
        "stock_variation_m": lambda b: ops.stock_variation(b, "m"),
        "avg_price_m": lambda b: ops.avg_price_period(b, "m", "Open"),
        "avg_return_m": lambda b: ops.avg_return(b, "m"),
        "moving_average_5": lambda b: ops.moving_average(b, "Open", WINDOW),
        "column_correlation": lambda b: ops.column_correlation(b, "Open", "High"),
        "correlation_matrix": lambda b: ops.correlation_matrix(b, SYMBOL_1, SYMBOL_2, "Close"),
        "correlation_pair": lambda b: ops.correlation_between(b, [(SYMBOL_1, SYMBOL_2)], "Open", "Open"),
        "stock_variation_d": lambda b: ops.stock_variation(b, "d"),
        "descriptive_stats": ops.descriptive_stats,
        "head_tail_3": lambda b: ops.head_and_tail(b, 3),
        "latest_average": lambda b: ops.latest_average(b, "Open", WINDOW, digits=None),
        "anchored_avg_return_w": lambda b: ops.anchored_avg_return(b, "w", digits=None),
        "anchored_monthly_variation": lambda b: ops.anchored_monthly_variation(b, digits=None),
        "anchored_volume_variation_w": lambda b: ops.anchored_volume_variation(b, "w"),
        "anchored_avg_price_m": lambda b: ops.anchored_avg_price(b, "m", "Open", digits=None),
        "anchored_return_rate_m": lambda b: ops.anchored_return_rate(b, "m"),
    }
    q |= {f"{name}_gaps": _q(lambda b, build=build, once=name in ONE_A_DAY: build(with_gaps(b, not once))) for name, build in gaps.items()}
    return q


SUMMARIES = ("num_observations", "date_span", "descriptive_stats", "missing_counts")
#: The second export of ``through_files`` begins here, the first ends a year later.
REEXPORT, FIRST_END = "1996-01-01", "1997-01-01"


def through_files(bars: DataFrame) -> DataFrame:
    """``bars`` written as price files in two exports that overlap by a year, and read again. The first one has
    its columns in another order and every Open too high by 1; the second one is written later."""
    folder = shared_path(bars.sparkSession, "price-files")
    early = bars.where(F.expr(f"Date < date'{FIRST_END}'")).withColumn("Open", F.expr("Open + 1"))
    write_bars_csv(early, f"{folder}/export-1", reversed(BARS_COLUMNS[1:]))
    write_bars_csv(bars.where(F.expr(f"Date >= date'{REEXPORT}'")), f"{folder}/export-2")
    return read_bars_csv(bars.sparkSession, [f"{folder}/export-1", f"{folder}/export-2"])


def through_dirty_files(bars: DataFrame) -> DataFrame:
    """Accepted and refused lines of price files in which the 13th of a month has no date and the 14th no volume."""
    folder = shared_path(bars.sparkSession, "dirty-files")
    day = F.expr("if(day(Date) = 13, 'Friday', cast(Date as string))")
    volume = F.expr("if(day(Date) = 14, '12.5', cast(Volume as string))")
    write_bars_csv(bars.withColumns({"Date": day, "Volume": volume}), folder)
    return line_counts(bars.sparkSession, folder)


def through_years(bars: DataFrame) -> DataFrame:
    """``bars`` of the range of days from a store laid out by year."""
    path = shared_path(bars.sparkSession, "bars-by-year")
    write_bars(bars, path, by_year=True)
    return read_bars(bars.sparkSession, path, ON, UNTIL)


def as_text(bars: DataFrame) -> DataFrame:
    """``bars`` as a price file has them: dates with a time and an offset, volumes with a decimal point."""
    day = F.concat(F.col("Date").cast("string"), F.lit(" 00:00:00-05:00"))
    return bars.withColumns({"Date": day, "Volume": F.concat(F.col("Volume").cast("string"), F.lit(".0"))})


#: The symbol that ``with_gaps`` gives a constant price, and the day it takes the date from.
CONSTANT_SYMBOL, LOST_DAY = "5-LOW", "1995-01-31"
#: Rows that get the date of the day before (if it has a row): days of the month, of two symbols.
REPEATING, REPEATED = (SYMBOL_1, SYMBOL_2), "day(Date) in (8, 15, 22)"


#: Queries on representative bars get no repeated dates: which row of a date represents its period is not defined.
ONE_A_DAY = ("period_return_m", "stock_variation_m")


def with_gaps(bars: DataFrame, repeat: bool = True) -> DataFrame:
    """``bars`` with holes: by day of the month an Open is null or 0, a Close NaN or null; one symbol has a
    constant price, each symbol one row without a date, and with ``repeat`` two symbols have several rows on some dates."""
    digit = "day(Date) % 10"
    opened = f"case when symbol = '{CONSTANT_SYMBOL}' then 100 when {digit} = 3 then null when {digit} = 5 then 0 else Open end"
    closed = f"case when symbol = '{CONSTANT_SYMBOL}' then 100 when {digit} = 7 then double('NaN') when {digit} = 9 then null else Close end"
    moved = f"if(symbol in {REPEATING} and {REPEATED}, date_add(Date, -1), Date)" if repeat else "Date"
    day = f"if(Date <> date'{LOST_DAY}', {moved}, null)"
    return bars.withColumns({"Open": F.expr(opened), "Close": F.expr(closed), "Date": F.expr(day)})


# --------------------------------------------------------------------------------------------------
# SQL twins (DuckDB). The bars adapter is shared text.

BARS_CTE = """q AS (
  SELECT l_orderkey AS k, SUM(CAST(l_quantity AS BIGINT)) AS v, MAX(l_discount) AS dv
  FROM lineitem GROUP BY l_orderkey),
bars AS (
  SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS "Date",
         MIN_BY(o_totalprice, o_orderkey) AS "Open", MAX(o_totalprice) AS "High",
         MIN(o_totalprice) AS "Low", MAX_BY(o_totalprice, o_orderkey) AS "Close",
         CAST(COALESCE(SUM(v), 0) AS BIGINT) AS "Volume",
         COALESCE(MAX(dv), 0.0) AS "Dividends", CAST(0 AS DOUBLE) AS "Stock Splits"
  FROM orders LEFT JOIN q ON o_orderkey = k
  GROUP BY o_orderpriority, CAST(o_orderdate AS DATE))"""

OPEN, CLOSE = '"Open"', '"Close"'


def _ident(name: str) -> str:
    return f'"{name}"'
W = 'PARTITION BY symbol ORDER BY "Date"'


def r6(expr: str) -> str:
    """SQL form of ``round_exact``: absorb noise at 9 decimals, then round half away from zero to 6."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,9)), 6) AS DOUBLE)"


BARS_COLS_R6 = ", ".join(
    ["symbol", '"Date"']
    + [f'{r6(_ident(c))} AS "{c}"' for c in ("Open", "High", "Low", "Close")]
    + ['"Volume"']
    + [f'{r6(_ident(c))} AS "{c}"' for c in ("Dividends", "Stock Splits")]
)


def _with(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join((BARS_CTE,) + ctes) + "\n"


def _pct(i: str, c: str) -> str:
    return f"((({c}) - ({i})) / NULLIF({i}, 0)) * 100"


def _rate(o: str, f: str, n: int = SHARES) -> str:
    return _pct(f"({o}) * {n}", f"({f}) * {n}")


def _keys(period: str, year: str = "year_nb") -> list[str]:
    return {
        "w": ['CAST(weekofyear("Date") AS INTEGER) AS week_nb', f'CAST(year("Date") AS INTEGER) AS {year}'],
        "m": ['CAST(month("Date") AS INTEGER) AS month_nb', f'CAST(year("Date") AS INTEGER) AS {year}'],
        "y": [f'CAST(year("Date") AS INTEGER) AS {year}'],
    }[period]


def _rep(period: str, src: str = "bars") -> str:
    keys = ", ".join(_keys(period))
    return (
        f'rep AS (SELECT symbol, {keys}, MAX("Date") AS "Date", MAX_BY("Open", "Date") AS "Open", '
        f'MAX_BY("Close", "Date") AS "Close" FROM {src} GROUP BY ALL)'
    )


_SHIFT = {"w": "W+1", "m": "M+1", "y": "Y+1"}


def _return_rate_period(period: str) -> str:
    if period == "d":
        return _with() + f'SELECT {BARS_COLS_R6}, {r6(f"COALESCE({_rate(OPEN, CLOSE)}, 0)")} AS "Return_Rate(%)" FROM bars'
    s = f"Open({_SHIFT[period]})"
    key = {"w": "", "m": "month_nb, ", "y": "year_nb, "}[period]
    target = CLOSE if period == "y" else "prev_open"
    return _with(
        _rep(period),
        f'r AS (SELECT *, LAG("Open") OVER ({W}) AS prev_open FROM rep)',
    ) + (
        f'SELECT symbol, "Date", {key}{r6(OPEN)} AS "Open", {r6("COALESCE(prev_open, 0)")} AS "{s}", '
        f'{r6(f"COALESCE({_rate(OPEN, target)}, 0)")} AS "Return_Rate(%)" FROM r'
    )


def _max_return_rate(period: str) -> str:
    inner = _return_rate_period(period)
    return f'SELECT symbol, {r6('MAX("Return_Rate(%)")')} AS "Max_Return_Rate" FROM ({inner}) t GROUP BY symbol'


def _stock_variation(period: str, where: str = "") -> str:
    src = f"(SELECT * FROM bars {where})"
    variation = r6(f'COALESCE("Open" - LAG("Open") OVER ({W}), 0)')
    if period == "d":
        return _with() + f'SELECT symbol, "Date", {variation} AS "Variation_Open_Price" FROM {src} b'
    return _with(_rep(period, src)) + f'SELECT symbol, "Date", {variation} AS "Variation_Open_Price" FROM rep'


def _period_return(period: str, where: str = "") -> str:
    src = f"(SELECT * FROM bars {where})"
    if period == "d":
        return _with() + f'SELECT {BARS_COLS_R6}, {r6(f"COALESCE({_pct(OPEN, CLOSE)}, 0)")} AS "Daily_Return" FROM {src} b'
    s = f"Close({_SHIFT[period]})"
    return _with(_rep(period, src), f'r AS (SELECT *, LEAD("Close") OVER ({W}) AS nxt FROM rep)') + (
        f'SELECT symbol, "Date", {r6(OPEN)} AS "Open", {r6("COALESCE(nxt, 0)")} AS "{s}", '
        f'{r6(f"COALESCE({_pct(OPEN, 'nxt')}, 0)")} AS "Benefit" FROM r'
    )


def _max_return(period: str) -> str:
    col = "Daily_Return" if period == "d" else "Benefit"
    return f'SELECT symbol, {r6(f'MAX("{col}")')} AS "Max_Return" FROM ({_period_return(period)}) t GROUP BY symbol'


def _avg_price(period: str) -> str:
    keys = _keys(period, "year")
    names = [k.rsplit(" AS ", 1)[1] for k in keys]
    return _with() + (
        f'SELECT symbol, {", ".join(keys)}, {r6("COALESCE(AVG(" + OPEN + "), 0)")} AS "Average_Price" '
        f'FROM bars GROUP BY symbol, {", ".join(names)}'
    )


def _avg_return(period: str) -> str:
    title = {"w": "Weekly", "m": "Monthly", "y": "Yearly"}[period]
    keys = _keys(period)
    names = [k.rsplit(" AS ", 1)[1] for k in keys]
    daily = f"COALESCE({_pct(OPEN, CLOSE)}, 0)"
    return _with() + (
        f'SELECT symbol, {", ".join(keys)}, {r6(f"COALESCE(AVG({daily}), 0)")} AS "{title}_Return" '
        f'FROM bars GROUP BY symbol, {", ".join(names)}'
    )


_DAYS = {"w": 7, "m": 30, "y": 365}


def _by_value(columns: str) -> str:
    """Sort order of the rows of one date."""
    return ", ".join(f"{c.strip()} NULLS FIRST" for c in columns.split(","))


def _chain(days: int, src: str = "bars", columns: str = '"Open", "Close"') -> list[str]:
    """Anchor chain: from the first day, repeatedly the first day at least ``days`` after the anchor. ``a`` has
    the first row of each anchor's date in the order of ``columns``."""
    return [
        f"firsts AS (SELECT * FROM {src} QUALIFY ROW_NUMBER() OVER (PARTITION BY symbol, \"Date\" ORDER BY {_by_value(columns)}) = 1)",
        f'nx AS (SELECT symbol, "Date", MIN("Date") OVER (PARTITION BY symbol ORDER BY "Date" '
        f"RANGE BETWEEN INTERVAL {days} DAY FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM firsts)",
        f'chain AS (SELECT symbol, MIN("Date") AS "Date", 0 AS k FROM {src} GROUP BY symbol '
        f'UNION ALL SELECT c.symbol, n.nxt, c.k + 1 FROM chain c JOIN nx n '
        f'ON n.symbol = c.symbol AND n."Date" = c."Date" WHERE n.nxt IS NOT NULL)',
        f'a AS (SELECT c.symbol, c."Date", c.k, b."Open", b."Close", b."Volume", '
        f'LAG(c."Date") OVER (PARTITION BY c.symbol ORDER BY c.k) AS pd, '
        f'LAG(b."Open") OVER (PARTITION BY c.symbol ORDER BY c.k) AS po, '
        f'LAG(b."Volume") OVER (PARTITION BY c.symbol ORDER BY c.k) AS pv '
        f'FROM chain c JOIN firsts b ON b.symbol = c.symbol AND b."Date" = c."Date")',
    ]


def _segments(days: int, value: str, src: str = "bars") -> list[str]:
    """Per boundary k >= 1, the mean of ``value`` over the rows after anchor k-1 (anchor 0 included)
    and before anchor k."""
    return _chain(days, src) + [
        f'v AS (SELECT b.symbol, b."Date", {value} AS val, ROW_NUMBER() OVER (PARTITION BY b.symbol, b."Date" ORDER BY {value} NULLS FIRST) AS rn FROM {src} b)',
        'm AS (SELECT v.*, CASE WHEN rn = 1 THEN COALESCE(a.k, -1) ELSE -1 END AS k FROM v LEFT JOIN a ON a.symbol = v.symbol AND a."Date" = v."Date")',
        'sg AS (SELECT *, MAX(k) OVER (PARTITION BY symbol ORDER BY "Date", rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg FROM m)',
        "savg AS (SELECT symbol, seg, AVG(val) AS av FROM sg WHERE k <= 0 GROUP BY symbol, seg)",
    ]


_SPAN = 'CAST(a.pd AS VARCHAR) || \' to \' || CAST(a."Date" AS VARCHAR)'


def _anchored_avg_price(period: str, field: str = "Open") -> str:
    return _with(*_segments(_DAYS[period], f'b."{field}"')) + (
        f'SELECT a.symbol, a."Date" AS "Period", {r6("s.av")} AS "Average_{field}_Price($)" FROM a '
        "LEFT JOIN savg s ON s.symbol = a.symbol AND s.seg = a.k - 1 WHERE a.k >= 1"
    )


def _anchored_avg_return(period: str) -> str:
    return _with(*_segments(_DAYS[period], 'b."Close" - b."Open"')) + (
        f'SELECT a.symbol, {_SPAN} AS "Period", {r6("s.av")} AS "Average_Stock_Variation_($)" FROM a '
        "LEFT JOIN savg s ON s.symbol = a.symbol AND s.seg = a.k - 1 WHERE a.k >= 1"
    )


def _anchored_return_rate(period: str) -> str:
    return _with(*_chain(_DAYS[period])) + (
        f'SELECT a.symbol, {_SPAN} AS "Period", {r6(_pct("po", CLOSE))} AS "Return_Rate_(%)" FROM a WHERE k >= 1'
    )


def _anchored_max_return_rate(period: str) -> str:
    return _with(*_chain(_DAYS[period])) + (
        f'SELECT symbol, {r6(f"MAX({_pct("po", CLOSE)})")} AS "Max_Return_Rate" FROM a WHERE k >= 1 GROUP BY symbol'
    )


def _last_row(columns: str, src: str) -> str:
    """The last row of each symbol in the order of the date and ``columns``; ``alone`` on its date or not."""
    order = ", ".join(f"{c.strip()} DESC NULLS LAST" for c in columns.split(","))
    return (
        f'lastrow AS (SELECT *, COUNT(*) OVER (PARTITION BY symbol, "Date") = 1 AS alone FROM {src} '
        f'QUALIFY ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY "Date" DESC, {order}) = 1)'
    )


def _anchored_volume_variation(period: str, src: str = "bars") -> str:
    return _with(
        *_chain(_DAYS[period], src, '"Volume"'),
        _last_row('"Volume"', src),
        'lastanchor AS (SELECT symbol, MAX_BY("Volume", k) AS av FROM a GROUP BY symbol)',
    ) + (
        'SELECT symbol, "Date" AS "Period", "Volume" - pv AS "Variation_Volume" FROM a WHERE k >= 1 '
        'UNION ALL SELECT b.symbol, b."Date", b."Volume" - la.av FROM lastrow b JOIN lastanchor la ON la.symbol = b.symbol '
        'WHERE NOT (alone AND EXISTS (SELECT 1 FROM a WHERE a.symbol = b.symbol AND a."Date" = b."Date" AND a.k >= 1))'
    )


def _anchored_monthly_variation(limit: int | None, src: str = "bars", shown=None) -> str:
    shown = shown or r6
    lim = "TRUE" if limit is None else f"k <= {limit}"
    tail_ok = "TRUE" if limit is None else f"mk < {limit}"
    return _with(
        *_chain(30, src),
        _last_row('"Open", "Close"', src),
        'lastanchor AS (SELECT symbol, MAX(k) AS mk, ARG_MAX_NULL("Open", k) AS ao FROM a GROUP BY symbol)',
    ) + (
        f'SELECT a.symbol, a."Date" AS "Period", {shown('a."Close" - a.po')} AS "Stock_Variation_($)" FROM a '
        "JOIN lastrow l ON l.symbol = a.symbol JOIN lastanchor la ON la.symbol = a.symbol "
        f'WHERE a.k >= 1 AND {lim} AND NOT ({tail_ok} AND l.alone AND a."Date" = l."Date") '
        f'UNION ALL SELECT b.symbol, b."Date", {shown("b." + CLOSE + " - la.ao")} FROM lastrow b '
        f"JOIN lastanchor la ON la.symbol = b.symbol WHERE {tail_ok}"
    )


_STATS_COLS = ["Date", "Open", "High", "Low", "Close", "Volume", "Dividends", "Stock Splits"]


def _descriptive_stats() -> str:
    parts = []
    for c in _STATS_COLS:
        q = f'"{c}"'
        if c in ("Date", "Volume"):
            parts += [f'MIN({q}) AS "min_{c}"', f'MAX({q}) AS "max_{c}"']
        else:
            parts += [f'{r6(f"MIN({q})")} AS "min_{c}"', f'{r6(f"MAX({q})")} AS "max_{c}"']
        if c != "Date":
            parts.append(f'{r6(f"STDDEV_SAMP({q})")} AS "stddev_{c}"')
    return _with() + f"SELECT symbol, {', '.join(parts)} FROM bars GROUP BY symbol"


def _missing_counts() -> str:
    parts = []
    for c in _STATS_COLS:
        if c in ("Date", "Volume"):
            parts.append(f'CAST(COUNT_IF("{c}" IS NULL) AS BIGINT) AS "missing_{c}"')
        else:
            parts.append(f'CAST(COUNT_IF("{c}" IS NULL OR isnan("{c}")) AS BIGINT) AS "missing_{c}"')
    return _with() + f"SELECT symbol, {', '.join(parts)} FROM bars GROUP BY symbol"


_MONTHS_SQL = "['Jan', 'Feb', 'Mar', 'Apr', 'May', 'Jun', 'Jul', 'Aug', 'Sept', 'Oct', 'Nov', 'Dec']"


GAPS_CTE = (
    BARS_CTE.replace("bars AS (", "whole AS (")
    + f""",
bars AS (
  SELECT symbol, CASE WHEN "Date" <> DATE '{LOST_DAY}' THEN CASE WHEN symbol IN {REPEATING} AND {REPEATED} THEN "Date" - 1 ELSE "Date" END END AS "Date",
         CASE WHEN symbol = '{CONSTANT_SYMBOL}' THEN 100.0::DOUBLE WHEN day("Date") % 10 = 3 THEN NULL
              WHEN day("Date") % 10 = 5 THEN 0.0 ELSE "Open" END AS "Open", "High", "Low",
         CASE WHEN symbol = '{CONSTANT_SYMBOL}' THEN 100.0::DOUBLE WHEN day("Date") % 10 = 7 THEN 'NaN'::DOUBLE
              WHEN day("Date") % 10 = 9 THEN NULL ELSE "Close" END AS "Close",
         "Volume", "Dividends", "Stock Splits"
  FROM whole)"""
)


def _gap_queries() -> dict[str, str]:
    """Twins of the queries on bars with holes: null and NaN become 0 where the operator fills."""
    fill = lambda e: f"CASE WHEN ({e}) IS NULL OR isnan({e}) THEN 0 ELSE ({e}) END"
    keep = lambda e: f"CASE WHEN isnan({e}) THEN ({e}) ELSE {r6(e)} END"
    names = ("Open", "High", "Low", "Close", "Volume", "Dividends", "Stock Splits")
    columns = lambda how: ", ".join(["symbol", '"Date"'] + [f'"{c}"' if c == "Volume" else f'{how(_ident(c))} AS "{c}"' for c in names])
    filled, kept = columns(lambda c: r6(fill(c))), columns(keep)
    dated = '(SELECT * FROM bars WHERE "Date" IS NOT NULL)'
    first = 'PARTITION BY symbol ORDER BY "Date" NULLS FIRST'
    keys, by = _keys("m"), 'GROUP BY symbol, month("Date"), year("Date")'
    month, year = (f"COALESCE({k.rsplit(' AS ', 1)[0]}, 0)" for k in keys)
    rep = _rep("m", dated).replace("MAX_BY(", "ARG_MAX_NULL(")
    nxt = f'r AS (SELECT *, LEAD("Close") OVER ({W}) AS nxt FROM rep)'
    daily, rate = _pct(OPEN, CLOSE), _rate(OPEN, CLOSE)
    variation = f'"Open" - LAG("Open") OVER ({W})'
    every = ", ".join(f"{_ident(c)} NULLS FIRST" for c in names)
    averaged = f'AVG("Open") OVER ({first}, {every} ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING)'
    backward = ", ".join(f"{_ident(c)} DESC NULLS LAST" for c in ("Date", *names))
    variation_d = f'"Open" - LAG("Open") OVER ({first}, "Open" NULLS FIRST)'
    stats = []
    for c in ("Date", *names):
        show = (lambda e: e) if c in ("Date", "Volume") else keep
        stats += [f'{show(f"{f}({_ident(c)})")} AS "{f.lower()}_{c}"' for f in ("MIN", "MAX")]
        if c == "Volume":
            stats.append(f'{r6("STDDEV_SAMP(" + _ident(c) + ")")} AS "stddev_{c}"')
        elif c != "Date":
            stats.append(f"CASE WHEN COUNT_IF(isnan({_ident(c)})) > 0 THEN 'NaN'::DOUBLE ELSE {r6(f'STDDEV_SAMP({_ident(c)}) FILTER (WHERE NOT isnan({_ident(c)}))')} END AS \"stddev_{c}\"")
    s = {
        "missing_counts": _missing_counts(),
        "period_return_d": _with() + f'SELECT {filled}, {r6(fill(daily))} AS "Daily_Return" FROM bars',
        "period_return_m": _with(rep, nxt)
        + f'SELECT symbol, "Date", {r6(fill(OPEN))} AS "Open", {r6(fill("nxt"))} AS "Close(M+1)", {r6(fill(_pct(OPEN, "nxt")))} AS "Benefit" FROM r',
        "return_rate_period_d": _with() + f'SELECT {filled}, {r6(fill(rate))} AS "Return_Rate(%)" FROM bars',
        "return_rate_until": _with()
        + f"SELECT {kept}, {keep(rate)} AS \"Return_Rate(%)\" FROM bars WHERE \"Date\" BETWEEN DATE '{ON}' AND DATE '{UNTIL}'",
        "stock_variation_m": _with(rep, f"v AS (SELECT symbol, \"Date\", {variation} AS d FROM rep)")
        + f'SELECT symbol, "Date", {r6(fill("d"))} AS "Variation_Open_Price" FROM v',
        "avg_price_m": _with() + f'SELECT symbol, {month} AS month_nb, {year} AS year, {r6("COALESCE(AVG(" + OPEN + "), 0)")} AS "Average_Price" FROM bars {by}',
        "avg_return_m": _with() + f'SELECT symbol, {month} AS month_nb, {year} AS year_nb, {r6(f"AVG({fill(daily)})")} AS "Monthly_Return" FROM bars {by}',
        "moving_average_5": _with(f"w AS (SELECT *, {averaged} AS av FROM bars)") + f'SELECT {filled}, {r6("COALESCE(av, 0)")} AS "Moving_Average" FROM w',
        "column_correlation": _with(f"z AS (SELECT symbol, COALESCE({OPEN}, 0) AS x, COALESCE(\"High\", 0) AS y FROM bars)")
        + f"SELECT symbol, CASE WHEN MIN(x) = MAX(x) THEN 'NaN'::DOUBLE ELSE {r6('CORR(x, y)')} END AS correlation FROM z GROUP BY symbol",
        "anchored_avg_price_m": _with(*_segments(30, 'b."Open"', dated))
        + f'SELECT a.symbol, a."Date" AS "Period", {r6("s.av")} AS "Average_Open_Price($)" FROM a LEFT JOIN savg s ON s.symbol = a.symbol AND s.seg = a.k - 1 WHERE a.k >= 1',
        "anchored_return_rate_m": _with(*_chain(30, dated)) + f'SELECT a.symbol, {_SPAN} AS "Period", {keep(_pct("po", CLOSE))} AS "Return_Rate_(%)" FROM a WHERE k >= 1',
    }
    s["stock_variation_d"] = _with(f'v AS (SELECT symbol, "Date", {variation_d} AS d FROM bars)') + f'SELECT symbol, "Date", {r6(fill("d"))} AS "Variation_Open_Price" FROM v'
    s["descriptive_stats"] = _with() + f"SELECT symbol, {', '.join(stats)} FROM bars GROUP BY symbol"
    s["head_tail_3"] = _with(
        f"h AS (SELECT *, ROW_NUMBER() OVER ({first}, {every}) AS rn, ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY {backward}) AS rd FROM bars)"
    ) + f"SELECT {kept} FROM h WHERE rn <= 3 UNION ALL SELECT {kept} FROM h WHERE rd <= 3"
    s["latest_average"] = _with(f"l AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY {backward}) AS rd FROM {dated})") + (
        f'SELECT {kept}, {r6("AVG(" + OPEN + ") OVER (PARTITION BY symbol)")} AS "Moving_Average" FROM l WHERE rd <= {WINDOW}'
    )
    s["correlation_pair"] = _with(f'i AS (SELECT symbol, COALESCE("Open", 0) AS v, ROW_NUMBER() OVER ({W}, "Open" NULLS FIRST) AS idx FROM {dated})') + (
        f"SELECT '{SYMBOL_1}' AS symbol_1, '{SYMBOL_2}' AS symbol_2, {r6('CORR(x.v, y.v)')} AS correlation "
        f"FROM i x JOIN i y ON x.idx = y.idx WHERE x.symbol = '{SYMBOL_1}' AND y.symbol = '{SYMBOL_2}'"
    )
    s["anchored_avg_return_w"] = _with(*_segments(7, 'b."Close" - b."Open"', dated)) + (
        f'SELECT a.symbol, {_SPAN} AS "Period", {keep("s.av")} AS "Average_Stock_Variation_($)" FROM a '
        "LEFT JOIN savg s ON s.symbol = a.symbol AND s.seg = a.k - 1 WHERE a.k >= 1"
    )
    s["anchored_monthly_variation"] = _anchored_monthly_variation(None, dated, keep)
    s["anchored_volume_variation_w"] = _anchored_volume_variation("w", dated)
    series = f'i AS (SELECT symbol, CASE WHEN NOT isnan("Close") THEN "Close" END AS val, ROW_NUMBER() OVER ({W}, "Close" NULLS FIRST) AS idx FROM {dated})'
    s["correlation_matrix"] = _correlation_matrix(series)
    once = GAPS_CTE.replace(f"symbol IN {REPEATING} AND {REPEATED}", "FALSE")
    return {f"{name}_gaps": sql.replace(BARS_CTE, once if name in ONE_A_DAY else GAPS_CTE) for name, sql in s.items()}


def _correlation_matrix(series: str) -> str:
    return _with(
        series,
        f"j AS (SELECT x.val AS d1, y.val AS d2 FROM (SELECT * FROM i WHERE symbol = '{SYMBOL_1}') x "
        f"FULL JOIN (SELECT * FROM i WHERE symbol = '{SYMBOL_2}') y ON x.idx = y.idx)",
        "c AS (SELECT CORR(d1, d1) AS c11, CORR(d1, d2) AS c12, CORR(d2, d2) AS c22 FROM j)",
    ) + (
        f"SELECT '{SYMBOL_1}' AS symbol_1, '{SYMBOL_2}' AS symbol_2, 'D1' AS variable, {r6('c11')} AS \"D1\", "
        f"{r6('c12')} AS \"D2\" FROM c UNION ALL SELECT '{SYMBOL_1}', '{SYMBOL_2}', 'D2', {r6('c12')}, "
        f"{r6('c22')} FROM c"
    )


def oracle_queries() -> dict[str, str]:
    s: dict[str, str] = _gap_queries()
    s["csv_parse"] = _with() + f"SELECT {BARS_COLS_R6} FROM bars"
    opened = f"CASE WHEN \"Date\" < DATE '{REEXPORT}' THEN \"Open\" + 1 ELSE \"Open\" END"
    s["csv_files"] = _with() + f"SELECT {BARS_COLS_R6.replace(r6(OPEN), r6(opened))} FROM bars"
    s["csv_line_counts"] = _with() + (
        'SELECT symbol, COUNT_IF(day("Date") NOT IN (13, 14))::BIGINT AS accepted, COUNT_IF(day("Date") IN (13, 14))::BIGINT AS refused FROM bars GROUP BY symbol'
    )
    s["run_dispatch"] = f"SELECT * FROM ({_return_rate_period('y')}) t WHERE symbol IN ('{SYMBOL_1}', '{SYMBOL_2}')"
    s["avg_price_m_newest"] = _avg_price("m")
    s["intraday_variation_rounded"] = _with() + f'SELECT {BARS_COLS_R6}, {r6("ROUND(" + CLOSE + " - " + OPEN + ", 3)")} AS "Stock_Variation" FROM bars'
    floored = '(SELECT symbol, "Date", floor("Open") AS "Open", "Close", "Volume" FROM bars)'
    s["anchored_avg_price_rounded"] = _with(*_segments(30, 'b."Open"', floored)) + (
        'SELECT a.symbol, a."Date" AS "Period", round_even(s.av, 3) AS "Average_Open_Price($)" FROM a '
        "LEFT JOIN savg s ON s.symbol = a.symbol AND s.seg = a.k - 1 WHERE a.k >= 1"
    )
    s["scan_bars"] = _with() + f"SELECT {BARS_COLS_R6} FROM bars"
    for p in "dwmy":
        s[f"max_return_rate_{p}"] = _max_return_rate(p)
        s[f"return_rate_period_{p}"] = _return_rate_period(p)
        s[f"stock_variation_{p}"] = _stock_variation(p)
        s[f"period_return_{p}"] = _period_return(p)
        s[f"max_return_{p}"] = _max_return(p)
    rng = f"WHERE \"Date\" BETWEEN DATE '{ON}' AND DATE '{UNTIL}'"
    s["return_rate_until"] = _with() + (
        f'SELECT {BARS_COLS_R6}, {r6(_rate(OPEN, CLOSE))} AS "Return_Rate(%)" FROM bars {rng}'
    )
    s["avg_price_until"] = _with() + (
        f'SELECT symbol, {r6("AVG(" + OPEN + ")")} AS "Average_Open_Price_($)" FROM bars {rng} GROUP BY symbol'
    )
    s["avg_price_until_every"] = _with() + (
        f'SELECT symbol, {r6(f"AVG({OPEN}) FILTER (WHERE {_ident('Date')} = DATE '{ONE_DAY}')")} AS "Average_Open_Price_($)" FROM bars GROUP BY symbol'
    )
    s["stock_variation_until_m"] = _stock_variation("m", rng)
    s["period_return_until_m"] = _period_return("m", rng)
    for p in "wmy":
        s[f"avg_price_{p}"] = _avg_price(p)
        s[f"avg_return_{p}"] = _avg_return(p)
        s[f"anchored_avg_price_{p}"] = _anchored_avg_price(p)
        s[f"anchored_avg_return_{p}"] = _anchored_avg_return(p)
        s[f"anchored_return_rate_{p}"] = _anchored_return_rate(p)
        s[f"anchored_max_return_rate_{p}"] = _anchored_max_return_rate(p)
        s[f"anchored_volume_variation_{p}"] = _anchored_volume_variation(p)
    s["moving_average_5"] = _with() + (
        f'SELECT {BARS_COLS_R6}, '
        f'{r6(f"AVG({OPEN}) OVER ({W} ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING)")} AS "Moving_Average" '
        "FROM bars"
    )
    s["correlation_pair"] = _with(f'i AS (SELECT symbol, "Open", "Close", ROW_NUMBER() OVER ({W}) AS idx FROM bars)') + (
        f"SELECT '{SYMBOL_1}' AS symbol_1, '{SYMBOL_2}' AS symbol_2, "
        f'{r6("CORR(COALESCE(x.\"Open\", 0), COALESCE(y.\"Close\", 0))")} AS correlation '
        f"FROM i x JOIN i y ON x.idx = y.idx WHERE x.symbol = '{SYMBOL_1}' AND y.symbol = '{SYMBOL_2}'"
    )
    s["correlation_matrix"] = _correlation_matrix(f'i AS (SELECT symbol, "Open" AS val, ROW_NUMBER() OVER ({W}) AS idx FROM bars)')
    s["dividend_revenus"] = _with() + (
        f'SELECT {BARS_COLS_R6}, {r6(f'"Dividends" * {DIVIDEND_SHARES}')} AS "Revenus" FROM bars'
    )
    s["anchored_avg_close_m"] = _anchored_avg_price("m", "Close")
    s["correlation_pair_by_date"] = _with() + (
        f"SELECT '{SYMBOL_1}' AS symbol_1, '{SYMBOL_2}' AS symbol_2, "
        f'{r6("CORR(COALESCE(x.\"Open\", 0), COALESCE(y.\"Close\", 0))")} AS correlation '
        f"FROM bars x JOIN bars y ON x.\"Date\" = y.\"Date\" WHERE x.symbol = '{SYMBOL_1}' AND y.symbol = '{SYMBOL_2}'"
    )
    s["dividend_return"] = _with() + (
        f'SELECT {BARS_COLS_R6}, {r6(f'"Dividends" * {DIVIDEND_SHARES}')} AS "Revenues" FROM bars'
    )
    s["head_tail_40"] = _with(
        f"h AS (SELECT *, ROW_NUMBER() OVER ({W}) AS rn, "
        'ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY "Date" DESC) AS rd FROM bars)'
    ) + f"SELECT {BARS_COLS_R6} FROM h WHERE rn <= 40 UNION ALL SELECT {BARS_COLS_R6} FROM h WHERE rd <= 40"
    s["num_observations"] = _with() + "SELECT symbol, COUNT(*) AS num_observations FROM bars GROUP BY symbol"
    s["date_span"] = _with() + (
        'SELECT symbol, MIN("Date") AS first_date, MAX("Date") AS last_date, '
        'CAST(MAX("Date") - MIN("Date") AS INTEGER) AS span_days FROM bars GROUP BY symbol'
    )
    s["most_common_day"] = _with(
        'c AS (SELECT symbol, CAST(dayofmonth("Date") AS INTEGER) AS day, COUNT(*) AS occurrences, '
        'MIN("Date") AS fs FROM bars GROUP BY ALL)',
        "r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY occurrences DESC, fs) AS rn FROM c)",
    ) + "SELECT symbol, day, occurrences FROM r WHERE rn = 1"
    s["descriptive_stats"] = _descriptive_stats()
    s["missing_counts"] = _missing_counts()
    s["column_correlation"] = _with() + (
        f'SELECT symbol, {r6("CORR(COALESCE(" + OPEN + ", 0), COALESCE(" + CLOSE + ", 0))")} AS correlation '
        "FROM bars GROUP BY symbol"
    )
    s["sampling_frequency"] = _with(
        f'g AS (SELECT symbol, CAST("Date" - LAG("Date") OVER ({W}) AS INTEGER) AS gap_days FROM bars)',
        "c AS (SELECT symbol, gap_days, COUNT(*) AS occurrences FROM g WHERE gap_days IS NOT NULL GROUP BY ALL)",
        "r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY occurrences DESC, gap_days) AS rn FROM c)",
    ) + (
        "SELECT symbol, gap_days, occurrences, CASE WHEN gap_days = 1 THEN 'daily' WHEN gap_days = 7 THEN 'weekly' "
        "WHEN gap_days BETWEEN 28 AND 31 THEN 'monthly' ELSE CAST(gap_days AS VARCHAR) || '-day' END AS frequency "
        "FROM r WHERE rn = 1"
    )
    s["anchored_monthly_variation"] = _anchored_monthly_variation(None)
    s["anchored_monthly_variation_first3"] = _anchored_monthly_variation(3)
    s["intraday_variation"] = _with() + f'SELECT {BARS_COLS_R6}, {r6(CLOSE + " - " + OPEN)} AS "Stock_Variation" FROM bars'
    s["max_daily_return"] = _with() + (
        f'SELECT symbol, {r6("MAX(" + CLOSE + " - " + OPEN + ")")} AS "Maximum_profit" FROM bars GROUP BY symbol'
    )
    s["latest_average"] = _with(
        'l AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY "Date" DESC) AS rd FROM bars)'
    ) + (
        f'SELECT {BARS_COLS_R6}, {r6("AVG(" + OPEN + ") OVER (PARTITION BY symbol)")} AS "Moving_Average" '
        f"FROM l WHERE rd <= {WINDOW}"
    )
    s["month_label"] = _with() + (
        f'SELECT {BARS_COLS_R6}, {_MONTHS_SQL}[month("Date")] || \'-\' || CAST(year("Date") AS VARCHAR) '
        'AS "Month_Label" FROM bars'
    )
    s["return_rate_until_by_year"] = s["return_rate_until"]
    summaries = [s[name] for name in (*SUMMARIES, "column_correlation")]
    s["run_many"] = "SELECT * FROM " + " JOIN ".join(f"({sql}) t{i}" + (" USING (symbol)" if i else "") for i, sql in enumerate(summaries))
    return s
