"""Pearson correlations: two columns of one symbol, and one symbol's series against another's."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.functions.columns import pearson
from candela.operators.calendar import dated
from candela.operators.positions import numbered


def _nulls(c: Column, nulls: str) -> Column:
    if nulls == "zero":
        return F.coalesce(c, F.lit(0.0))
    if nulls == "drop":
        return c
    raise ValueError("nulls must be 'zero' or 'drop'")


# E8
def column_correlation(bars: DataFrame, col1: str, col2: str, nulls: str = "zero") -> DataFrame:
    """Pearson correlation of two columns per symbol: ``correlation``.

    ``nulls="zero"`` counts a missing value as 0 (the behaviour of ``DataFrame.stat.corr``);
    ``nulls="drop"`` leaves out rows where either value is missing.
    """
    return bars.groupBy("symbol").agg(*correlation_columns(bars, col1, col2, nulls))


def correlation_columns(bars: DataFrame, col1: str, col2: str, nulls: str = "zero") -> list[Column]:
    """Aggregates of ``column_correlation``."""
    x, y = _nulls(F.col(col1).cast("double"), nulls), _nulls(F.col(col2).cast("double"), nulls)
    return [pearson(x, y).alias("correlation")]


def _indexed(bars: DataFrame, on: str, **columns: str) -> DataFrame:
    """``(symbol, key, values)`` with key = position in order of the date and then of the values
    (``on="index"``) or the date; the values are named by the keyword arguments."""
    if on not in ("index", "date"):
        raise ValueError("on must be 'index' or 'date'")
    rows = dated(bars).select("symbol", "Date", *[F.col(c).cast("double").alias(name) for name, c in columns.items()])
    return numbered(rows, "key").drop("Date") if on == "index" else rows.withColumnRenamed("Date", "key")


# A12
def correlation_between(
    bars: DataFrame,
    pairs: Iterable[tuple[str, str]],
    col1: str = "Open",
    col2: str = "Open",
    on: str = "index",
    nulls: str = "zero",
) -> DataFrame:
    """Correlation of ``col1`` of ``symbol_1`` with ``col2`` of ``symbol_2`` for each requested pair.

    ``on="index"`` pairs the i-th day of one series with the i-th day of the other (the longer series
    is cut to the shorter one); ``on="date"`` pairs equal dates. Output
    ``symbol_1, symbol_2, correlation``. Work is linear in the pairs asked for: ``bars`` is read and
    indexed once, a series goes to the pairs that name it, and a pair's two series meet in an aggregate by
    key. No pair is formed within a symbol.
    """
    pair_list = [(str(a), str(b)) for a, b in pairs]
    if not pair_list:
        raise ValueError("at least one (symbol_1, symbol_2) pair is needed")
    sides = [(s, a, b, side) for a, b in dict.fromkeys(pair_list) for side, s in ((1, a), (2, b))]
    roles = bars.sparkSession.createDataFrame(sides, "symbol string, symbol_1 string, symbol_2 string, side int")
    listed = bars.join(roles.select("symbol").distinct(), "symbol", "left_semi")
    first, second = F.col("side") == 1, F.col("side") == 2
    met = (
        _indexed(listed, on, x=col1, y=col2)
        .join(roles, "symbol")
        .groupBy("symbol_1", "symbol_2", "key")
        .agg(
            F.max(F.when(first, F.col("x"))).alias("x"),
            F.max(F.when(second, F.col("y"))).alias("y"),
            F.count_distinct("side").alias("sides") if on == "date" else F.count(F.lit(1)).alias("sides"),
        )
        .where("sides = 2")
    )
    return met.groupBy("symbol_1", "symbol_2").agg(
        pearson(_nulls(F.col("x"), nulls), _nulls(F.col("y"), nulls)).alias("correlation")
    )


# N9
def correlation_matrix(bars: DataFrame, symbol_1: str, symbol_2: str, column: str = "Open") -> DataFrame:
    """2 x 2 Pearson matrix of ``column`` for two symbols, series aligned by position (every position of
    either series is kept, like a positional concat) and missing values left out pairwise.

    Rows ``variable`` = D1 (``symbol_1``) and D2 (``symbol_2``), columns ``D1``, ``D2``.
    """
    series = _indexed(bars.where(F.col("symbol").isin(symbol_1, symbol_2)), "index", value=column)
    # Side by side by position: one aggregate on the position key (each symbol has one row per
    # position) instead of a self full outer join, so the series are shuffled once.
    both = series.groupBy("key").agg(
        F.max(F.when(F.col("symbol") == symbol_1, F.col("value"))).alias("D1"),
        F.max(F.when(F.col("symbol") == symbol_2, F.col("value"))).alias("D2"),
    )
    # NaN counts as missing, as null does.
    both = both.select(*[F.when(~F.isnan(F.col(c).cast("double")), F.col(c)).alias(c) for c in ("D1", "D2")])
    stats = both.agg(
        pearson("D1", "D1").alias("c11"), pearson("D1", "D2").alias("c12"), pearson("D2", "D2").alias("c22")
    )
    rows = F.array(
        F.struct(F.lit("D1").alias("variable"), F.col("c11").alias("D1"), F.col("c12").alias("D2")),
        F.struct(F.lit("D2").alias("variable"), F.col("c12").alias("D1"), F.col("c22").alias("D2")),
    )
    return stats.select(
        F.lit(symbol_1).alias("symbol_1"), F.lit(symbol_2).alias("symbol_2"), F.inline(rows)
    )
