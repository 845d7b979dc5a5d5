"""Row-level and latest-rows operators: intraday variation, max daily profit, latest-n average, month labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.functions.columns import month_label, round_to
from candela.operators.positions import total_order


# N4
def intraday_variation(bars: DataFrame, digits: int | None = 3) -> DataFrame:
    """Every column plus ``Stock_Variation = Close - Open`` rounded to ``digits``."""
    return bars.withColumn("Stock_Variation", round_to(F.col("Close") - F.col("Open"), digits))


# N6
def max_daily_return(bars: DataFrame, digits: int | None = 3) -> DataFrame:
    """Largest intraday variation per symbol: ``Maximum_profit``."""
    return (
        intraday_variation(bars, digits)
        .groupBy("symbol")
        .agg(F.max("Stock_Variation").alias("Maximum_profit"))
    )


# N8
def latest_average(bars: DataFrame, field: str = "Open", n: int = 5, digits: int | None = 3) -> DataFrame:
    """The latest ``n`` rows of each symbol with ``Moving_Average``: one number per symbol, the mean of
    ``field`` over those rows. The top-n filter is planned as a per-partition group limit before the
    shuffle, so only ``n`` rows per symbol and map task are exchanged. Rows of one date are in the order of
    their values."""
    if n < 1:
        raise ValueError("n must be >= 1")
    newest_first = Window.partitionBy("symbol").orderBy(*total_order(bars.columns, descending=True))
    latest = (
        bars.where(F.col("Date").isNotNull())
        .withColumn("_rn", F.row_number().over(newest_first))
        .where(F.col("_rn") <= n)
        .drop("_rn")
    )
    avg = F.avg(field).over(Window.partitionBy("symbol"))
    return latest.withColumn("Moving_Average", round_to(avg, digits))


# N3
def with_month_label(bars: DataFrame) -> DataFrame:
    """Every column plus ``Month_Label`` such as ``"Jan-2024"`` (September is ``"Sept"``)."""
    return bars.withColumn("Month_Label", month_label(F.month("Date"), F.year("Date")))
