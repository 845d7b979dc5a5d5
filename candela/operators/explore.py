"""Exploration: previews, counts, spans, most common values, descriptive statistics, missing values,
sampling frequency. All per symbol and in one job over all symbols."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.operators.calendar import by_date, dated
from candela.schema import HEAD_TAIL_ROWS

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_FLOATING = (T.FloatType, T.DoubleType)


def _value_columns(df: DataFrame) -> list[T.StructField]:
    return [f for f in df.schema.fields if f.name != "symbol"]


# E1
def head_and_tail(bars: DataFrame, n: int = HEAD_TAIL_ROWS) -> DataFrame:
    """First ``n`` and last ``n`` rows of each symbol by date (UNION ALL: a series shorter than ``2n``
    shows rows twice). Rows without a date come first, rows of one date in the order of their values.

    One read: each row stands for either end, and one row number by (symbol, end) runs from both, through sort
    columns that are null at the other end. Its filter is planned as a group limit before the shuffle, so ``2n``
    rows of a symbol leave a map task."""
    ends = bars.withColumn("_end", F.explode(F.array(F.lit("head"), F.lit("tail"))))
    order = []
    for c in ["Date", *(c for c in bars.columns if c not in ("symbol", "Date"))]:
        order += [F.expr(f"if(_end = 'head', `{c}`, null)").asc_nulls_first(), F.expr(f"if(_end = 'tail', `{c}`, null)").desc_nulls_last()]
    place = F.row_number().over(Window.partitionBy("symbol", "_end").orderBy(*order))
    return ends.withColumn("_place", place).where(F.col("_place") <= n).select(*[f"`{c}`" for c in bars.columns])


# E2
def num_observations(bars: DataFrame) -> DataFrame:
    """Row count per symbol: ``num_observations``."""
    return bars.groupBy("symbol").agg(*observation_columns(bars))


def observation_columns(bars: DataFrame) -> list[Column]:
    """Aggregates of ``num_observations``."""
    return [F.count(F.lit(1)).alias("num_observations")]


# E3
def date_span(bars: DataFrame) -> DataFrame:
    """First and last date and the days between them per symbol: ``first_date, last_date, span_days``."""
    return bars.groupBy("symbol").agg(*span_columns(bars))


def span_columns(bars: DataFrame) -> list[Column]:
    """Aggregates of ``date_span``."""
    return [
        F.min("Date").alias("first_date"),
        F.max("Date").alias("last_date"),
        F.date_diff(F.max("Date"), F.min("Date")).alias("span_days"),
    ]


# E5
def most_common(df: DataFrame, column: str, order_by: str = "Date") -> DataFrame:
    """Most frequent value of ``column`` per symbol: ``symbol, <column>, occurrences``.

    Ties go to the value seen first in ``order_by`` order (as a counter filled in that order would).
    Counting is a partial-then-final aggregation on (symbol, value); the top-1 pick runs on the counts.
    """
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy("symbol", column)
        .agg(F.count(F.lit(1)).alias("occurrences"), F.min(order_by).alias("_first_seen"))
    )
    best = Window.partitionBy("symbol").orderBy(F.col("occurrences").desc(), F.col("_first_seen").asc())
    return (
        counts.withColumn("_rn", F.row_number().over(best))
        .where(F.col("_rn") == 1)
        .select("symbol", column, "occurrences")
    )


# E4 + E5
def most_common_day(bars: DataFrame) -> DataFrame:
    """Most frequent day of the month per symbol: ``symbol, day, occurrences``."""
    return most_common(dated(bars).withColumn("day", F.dayofmonth("Date")), "day")


# E6
def descriptive_stats(bars: DataFrame) -> DataFrame:
    """Per symbol: ``min_<c>`` and ``max_<c>`` of every column and the sample ``stddev_<c>`` of the numeric
    ones, as one wide row."""
    return bars.groupBy("symbol").agg(*stats_columns(bars))


def stats_columns(bars: DataFrame) -> list[Column]:
    """Aggregates of ``descriptive_stats``."""
    aggs = []
    for f in _value_columns(bars):
        aggs += [F.min(f"`{f.name}`").alias(f"min_{f.name}"), F.max(f"`{f.name}`").alias(f"max_{f.name}")]
        if isinstance(f.dataType, _NUMERIC):
            aggs.append(F.stddev_samp(f"`{f.name}`").alias(f"stddev_{f.name}"))
    return aggs


# E7
def missing_counts(bars: DataFrame) -> DataFrame:
    """Per symbol: ``missing_<c>`` = rows where ``c`` is null (or NaN for floating columns)."""
    return bars.groupBy("symbol").agg(*missing_columns(bars))


def missing_columns(bars: DataFrame) -> list[Column]:
    """Aggregates of ``missing_counts``."""
    aggs = []
    for f in _value_columns(bars):
        c = F.col(f"`{f.name}`")
        missing = c.isNull() | F.isnan(c) if isinstance(f.dataType, _FLOATING) else c.isNull()
        aggs.append(F.count_if(missing).alias(f"missing_{f.name}"))
    return aggs


# E9
def sampling_frequency(bars: DataFrame) -> DataFrame:
    """Usual spacing of the records per symbol: ``gap_days`` (most frequent day gap between consecutive
    dates, the smallest on ties), ``occurrences`` and ``frequency`` = daily (1), weekly (7),
    monthly (28..31) or ``"<n>-day"``."""
    gaps = dated(bars).select("symbol", F.date_diff("Date", F.lag("Date").over(by_date())).alias("gap_days"))
    mode = most_common(gaps.withColumn("_g", F.col("gap_days")), "gap_days", order_by="_g")
    label = (
        F.when(F.col("gap_days") == 1, F.lit("daily"))
        .when(F.col("gap_days") == 7, F.lit("weekly"))
        .when(F.col("gap_days").between(28, 31), F.lit("monthly"))
        .otherwise(F.concat(F.col("gap_days").cast("string"), F.lit("-day")))
    )
    return mode.withColumn("frequency", label)
