"""Parquet tables: the driver's TPC-H-like tables, the price-bar adapter over them, and the bars sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.schema import BARS_COLUMNS


#: Folder column of a store laid out by year.
YEAR = "bar_year"


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bars_from_orders(orders: DataFrame, lineitem: DataFrame, on=None, until=None) -> DataFrame:
    """Daily price bars derived from orders: one symbol per order priority, one bar per order day.

    Open / Close are the total price of the day's lowest / highest order key, High / Low the extreme
    total prices, Volume the day's ordered quantity and Dividends the day's largest discount.

    Plan: line items are pre-aggregated per order (partial aggregation before the shuffle, one row per
    order after it), joined to orders on the order key, and aggregated per (priority, day) with partial
    aggregation, so the last shuffle carries at most one row per (priority, day, map task). With a range of
    days (``on`` to ``until``, both inclusive) only its orders are read, and only their line items are aggregated.
    """
    if on is not None and until is not None:
        orders = orders.where(F.col("o_orderdate").cast("date").between(F.to_date(F.lit(on)), F.to_date(F.lit(until))))
        lineitem = lineitem.join(orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    # SQL texts, as each Python call on a column costs milliseconds, more than the work on a small table.
    per_order = lineitem.groupBy(F.expr("l_orderkey as k")).agg(
        F.expr("sum(cast(l_quantity as bigint)) as v"), F.expr("max(l_discount) as dv")
    )
    joined = orders.select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority").join(
        per_order, F.expr("o_orderkey = k"), "left"
    )
    bars = joined.groupBy(F.expr("o_orderpriority as symbol"), F.expr("cast(o_orderdate as date) as Date")).agg(
        F.expr("min_by(o_totalprice, o_orderkey) as Open"),
        F.expr("max(o_totalprice) as High"),
        F.expr("min(o_totalprice) as Low"),
        F.expr("max_by(o_totalprice, o_orderkey) as Close"),
        F.expr("cast(coalesce(sum(v), 0) as bigint) as Volume"),
        F.expr("coalesce(max(dv), double(0)) as Dividends"),
        F.expr("double(0) as `Stock Splits`"),
    )
    return bars.select(*[f"`{c}`" for c in BARS_COLUMNS])


def load_bars(spark: SparkSession, sf_dir: str, on=None, until=None) -> DataFrame:
    """``bars`` computed from the ``orders`` and ``lineitem`` tables of a data directory, of a range of days if given."""
    return bars_from_orders(load_table(spark, sf_dir, "orders"), load_table(spark, sf_dir, "lineitem"), on, until)


def write_bars(bars: DataFrame, path: str, mode: str = "errorifexists", by_year: bool = False) -> None:
    """Write ``bars`` as Parquet in ranges of (symbol, date), sorted inside each file; a large symbol spans several.

    Sorted dates give tight row-group statistics, so date-range filters prune row groups. With ``by_year``
    the files are laid out in a folder for each year (and one for rows without a date), so a range of days
    lists and opens the files of its years only: see ``read_bars``.
    """
    if by_year:
        bars = bars.withColumn(YEAR, F.year("Date"))
        ranges = bars.repartitionByRange(YEAR, "symbol", "Date").sortWithinPartitions(YEAR, "symbol", "Date")
        ranges.write.mode(mode).partitionBy(YEAR).parquet(path)
        return
    (
        bars.repartitionByRange("symbol", "Date")
        .sortWithinPartitions("symbol", "Date")
        .write.mode(mode)
        .parquet(path)
    )


def read_bars(spark: SparkSession, path: str, on=None, until=None) -> DataFrame:
    """Stored ``bars``, of the days from ``on`` to ``until`` (both inclusive) if given. In a store laid out by year
    the range becomes a filter on the folders as well, so that other years are not even listed."""
    bars = spark.read.parquet(path)
    for bound, op in ((on, ">="), (until, "<=")):
        if bound is not None:
            day = F.to_date(F.lit(str(bound)))
            bars = bars.where(F.col("Date") >= day if op == ">=" else F.col("Date") <= day)
            if YEAR in bars.columns:
                year = int(str(bound)[:4])
                bars = bars.where(F.col(YEAR) >= year if op == ">=" else F.col(YEAR) <= year)
    return bars.select(*[f"`{c}`" for c in BARS_COLUMNS])
