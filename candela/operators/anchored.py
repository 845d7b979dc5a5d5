"""Anchored-period analytics: periods of n days counted from a moving anchor day.

Rule, per symbol in date order: the first day is anchor 0; a day at least ``n`` days after the current
anchor is a *boundary* and becomes the next anchor. Segment ``s`` holds the rows after anchor ``s`` and
before anchor ``s + 1``; segment 0 also holds anchor 0, later anchors belong to no segment. Of rows with one
date only the first can be an anchor (their distance is 0), in the order of the values that an operator uses.

Spark formulation (no Python, no driver loop, one read, no window): rows are first summed up by (symbol, day)
with partial aggregation, so that a symbol's rows never meet; only its distinct days do, one short struct
each. The calendar bounds them, not the data: a century has 36,525 days, which take some 10 MB, and no symbol
has more than the 3.7 million days of the DATE type, about 1 GB.
Over them lies the *successor graph*: from each day to the first day ``n`` or more days later. The anchors are the
path from the first day, found by *pointer doubling*: each round joins the pointers end to end, which doubles
their length, and appends to the path what lies one such length behind it. A path of L anchors takes log2(L)
rounds, each linear in the days. One row per anchor leaves, with what the operators need of it.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.functions.columns import pct, round_to
from candela.operators.calendar import dated
from candela.operators.daily import intraday_variation
from candela.schema import MONTHLY_VARIATION_DAYS, period_days


def _successors(n: int) -> Column:
    """Place of the first day at least ``n`` days after each day of the ascending array ``days`` (its size if
    there is none). Days differ, so that place is at most ``n`` ahead: a binary search over these."""
    steps = ", ".join(str(1 << k) for k in reversed(range(max(1, ceil(log2(n + 1))))))
    return F.expr(
        f"transform(days, (day, place) -> 1 + aggregate(array({steps}), place, (at, step) -> "
        f"if(get(days, at + step) < day + {n}, at + step, at)))"
    )


def _path(n: int) -> Column:
    """Places of the anchors: the path from place 0 along ``successors``, by pointer doubling."""
    return F.expr(f"""
        filter(
            aggregate(
                sequence(1, greatest(1, cast(ceil(log2(floor((element_at(days, -1) - days[0]) / {n}) + 1)) as int))),
                struct(concat(successors, array(size(days))) as jump, array(0) as path),
                (state, round) -> struct(
                    transform(state.jump, place -> get(state.jump, place)) as jump,
                    concat(state.path, transform(state.path, place -> get(state.jump, place))) as path),
                state -> state.path),
            place -> place < size(days))
    """)


def _on_path(summary: DataFrame, n: int) -> DataFrame:
    """``symbol``, ``rows`` (its days in order, as structs of the columns of ``summary``), ``path`` (places of the anchors)."""
    if n < 1:
        raise ValueError("days must be >= 1")
    others = [c for c in summary.columns if c not in ("symbol", "Date")]
    gathered = summary.groupBy("symbol").agg(F.array_sort(F.collect_list(F.struct("Date", *others))).alias("rows"))
    days = gathered.withColumn("days", F.expr("transform(rows, r -> unix_date(r.Date))"))
    return days.withColumn("successors", _successors(n)).select("symbol", "rows", _path(n).alias("path"))


def _summary(bars: DataFrame, columns: tuple[str, ...], *more: Column) -> DataFrame:
    """One row per (symbol, day) with ``first``: ``columns`` of its first row in the order of their values."""
    return dated(bars).groupBy("symbol", "Date").agg(F.min(F.struct(*columns)).alias("first"), *more)


def _whole_day(columns: tuple[str, ...]) -> tuple[Column, Column]:
    """The last row of a day in the order of values, and the number of its rows."""
    return F.max(F.struct(*columns)).alias("last"), F.count(F.lit(1)).alias("n")


def _anchors(summary: DataFrame, n: int, segment: str = "") -> DataFrame:
    """One row per anchor: ``symbol``, ``k`` (its number), ``here`` (its day), ``before`` (the anchor before),
    ``next_date`` (the boundary that closes its segment, or null), ``is_last``, ``end`` (last day of the symbol) and
    ``segment``, SQL over ``later``, the days after the anchor and before the next one."""
    more = f", {segment}" if segment else ""
    row = f"""
        struct(
            k, get(rows, start) as here, get(rows, get(path, k - 1)) as before, get(rows, get(path, k + 1)).Date as next_date,
            k = size(path) - 1 as is_last, element_at(rows, -1) as end{more})
    """
    row = row.replace("later", "slice(rows, start + 2, coalesce(get(path, k + 1), size(rows)) - start - 1)")
    return _on_path(summary, n).selectExpr("symbol", f"inline(transform(path, (start, k) -> {row}))")


def mark_anchors(bars: DataFrame, days: int) -> DataFrame:
    """One row per symbol and day: ``symbol``, ``Date``, ``k`` (number of the anchor that the day is, or -1),
    ``seg`` (number of the last anchor up to the day), ``at`` (place after that anchor), ``n_anchors`` (of the
    symbol), ``is_last`` (last day of the symbol). A null symbol is a symbol like any other."""
    part = "slice(rows, start + 1, coalesce(get(path, k + 1), size(rows)) - start)"
    cut = f"inline(transform(path, (start, k) -> struct(k as seg, start, {part} as part)))"
    parts = _on_path(dated(bars).select("symbol", "Date").distinct(), days).selectExpr(
        "symbol", "size(rows) as n", "size(path) as n_anchors", cut
    )
    rows = parts.selectExpr("symbol", "n", "n_anchors", "seg", "start", "posexplode(part) as (at, day)")
    return rows.selectExpr(
        "symbol", "day.Date", "if(at = 0, seg, -1) as k", "seg", "at", "n_anchors", "start + at + 1 = n as is_last"
    )


def _span(first: str, last: str) -> str:
    return f"concat(cast({first} as string), ' to ', cast({last} as string))"


def _segment_averages(bars: DataFrame, n: int, value: str) -> DataFrame:
    """``symbol``, ``Date`` (of the anchor), ``next_date`` (of the boundary), ``average``: the mean of ``value`` over
    each closed segment, null when it is empty. The row that is an anchor after the first counts nowhere; other
    rows of its day count in the segment that it opens."""
    summary = _summary(bars, (value,), F.sum(value).cast("double").alias("total"), F.count(value).alias("filled"))
    after = """
        aggregate(later, struct(double(0) as total, 0L as filled), (sofar, r) -> struct(
            sofar.total + if(r.filled > 0, r.total, double(0)) as total, sofar.filled + r.filled as filled)) as after
    """
    rows = _anchors(summary, n, after).where("next_date is not null")
    # Of the anchor's own day, its first row is left out, but for anchor 0.
    own = F.expr(f"if(k > 0, here.first.`{value}`, null)")
    rows = rows.withColumn("own", own).withColumn("own_filled", F.expr("here.filled - if(own is null, 0, 1)"))
    total = "after.total + if(own_filled > 0, here.total - coalesce(own, 0), double(0))"
    return rows.selectExpr(
        "symbol", "here.Date as Date", "next_date", f"try_divide({total}, nullif(after.filled + own_filled, 0)) as average"
    )


# N2
def anchored_avg_price(bars: DataFrame, period: str, field: str = "Open", digits: int | None = 3) -> DataFrame:
    """At each boundary: the boundary date (``Period``) and the mean ``field`` of the segment that the
    boundary closes, ``Average_{field}_Price($)``. The open last segment is not reported."""
    if field not in ("Open", "Close"):
        raise ValueError("field must be 'Open' or 'Close'")
    rows = _segment_averages(bars, period_days(period), field)
    return rows.select(
        "symbol",
        F.col("next_date").alias("Period"),
        round_to("average", digits).alias(f"Average_{field}_Price($)"),
    )


# N7
def anchored_avg_return(bars: DataFrame, period: str, digits: int | None = 3) -> DataFrame:
    """Mean intraday variation (Close - Open, rounded to ``digits``) of each closed segment:
    ``Period = "<anchor> to <boundary>"``, ``Average_Stock_Variation_($)``."""
    days = period_days(period)
    rows = _segment_averages(intraday_variation(bars, digits), days, "Stock_Variation")
    return rows.select(
        "symbol",
        F.expr(_span("Date", "next_date")).alias("Period"),
        round_to("average", digits).alias("Average_Stock_Variation_($)"),
    )


# N10
def anchored_return_rate(bars: DataFrame, period: str) -> DataFrame:
    """At each boundary, the return from the previous anchor's Open to the boundary's Close:
    ``Period = "<anchor> to <boundary>"``, ``Return_Rate_(%)`` (not rounded)."""
    rows = _anchors(_summary(bars, ("Open", "Close")), period_days(period))
    return rows.where("k >= 1").select(
        "symbol",
        F.expr(_span("before.Date", "here.Date")).alias("Period"),
        pct(F.col("before.first.Open"), F.col("here.first.Close")).alias("Return_Rate_(%)"),
    )


# N11
def anchored_max_return_rate(bars: DataFrame, period: str) -> DataFrame:
    """Largest ``Return_Rate_(%)`` of ``anchored_return_rate`` per symbol: ``Max_Return_Rate``."""
    return (
        anchored_return_rate(bars, period)
        .groupBy("symbol")
        .agg(F.max("Return_Rate_(%)").alias("Max_Return_Rate"))
    )


def _with_tail(rows: DataFrame, boundary: str, in_limit: str, tail: str, tail_wanted: str) -> DataFrame:
    """``symbol``, ``Period``, ``value`` (SQL): each ``boundary`` within the limit, and of the last anchor, where wanted,
    the ``tail`` up to the last row. ``ends`` says whether the last row is itself the last boundary; a tail that
    is wanted even then takes the boundary's place."""
    ends = rows.withColumn("ends", F.expr("is_last and k >= 1 and here.Date = end.Date and end.n = 1"))
    wanted = ends.withColumn("tail_wanted", F.expr(f"is_last and ({tail_wanted})"))
    both = f"""
        array(
            struct(k >= 1 and {in_limit} and not (ends and tail_wanted) as wanted, here.Date as Period, {boundary} as value),
            struct(tail_wanted as wanted, end.Date as Period, {tail} as value))
    """
    return wanted.selectExpr("symbol", f"inline(filter({both}, r -> r.wanted))").drop("wanted")


# N5
def anchored_monthly_variation(
    bars: DataFrame, max_periods: int | None = None, digits: int | None = 3, days: int = MONTHLY_VARIATION_DAYS
) -> DataFrame:
    """Price change over anchored 30-day periods: ``Period`` (date), ``Stock_Variation_($)``.

    Each boundary reports its Close minus the previous anchor's Open. The last row of the symbol is
    reported too, as its Close minus the Open of the anchor in force (its own Open when the last row is
    itself a boundary, replacing the boundary value). With ``max_periods = p > 0`` only the first ``p``
    boundaries are reported, and the last row only when the symbol has fewer than ``p`` boundaries.
    """
    columns = ("Open", "Close")
    rows = _anchors(_summary(bars, columns, *_whole_day(columns)), days)
    limit = max_periods if (max_periods is not None and max_periods > 0) else None
    out = _with_tail(
        rows,
        boundary="here.first.Close - before.first.Open",
        in_limit="true" if limit is None else f"k <= {limit}",
        tail="end.last.Close - here.first.Open",
        tail_wanted="true" if limit is None else f"k < {limit}",  # the last anchor's number is that of the boundaries
    )
    return out.select("symbol", "Period", round_to("value", digits).alias("Stock_Variation_($)"))


# N13
def anchored_volume_variation(bars: DataFrame, period: str) -> DataFrame:
    """Volume change between consecutive anchors, and from the last anchor to the last row:
    ``Period`` (date), ``Variation_Volume``. A one-row series reports 0."""
    columns = ("Volume",)
    rows = _anchors(_summary(bars, columns, *_whole_day(columns)), period_days(period))
    out = _with_tail(
        rows,
        boundary="here.first.Volume - before.first.Volume",
        in_limit="true",
        tail="end.last.Volume - here.first.Volume",
        tail_wanted="not ends",
    )
    return out.withColumnRenamed("value", "Variation_Volume")
