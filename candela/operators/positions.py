"""Places of rows in their symbol, and windows over neighbours, without a task that holds a whole symbol.

Rows of a symbol are in a *total order*: by date (none first), then by the values they carry, so results do not
depend on the order in which rows are read; rows that agree in all of it are interchangeable.

``numbered`` counts rows by (symbol, year), adds these counts up over the years (one short row each), and numbers
rows inside their year only. ``with_neighbours`` deals rows out in blocks of successive places and gives each
block the rows of the next or previous one that its windows reach (a halo), so a symbol of any length is spread.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a block, unless windows reach further.
BLOCK_ROWS = 4096


def total_order(columns: Iterable[str], descending: bool = False) -> list[Column]:
    """Sort order by ``Date``, then the other ``columns``; nulls first, and last where ``descending``."""
    names = ["Date", *(c for c in columns if c not in ("symbol", "Date"))]
    cols = [F.col(f"`{c}`") for c in names]
    return [c.desc_nulls_last() if descending else c.asc_nulls_first() for c in cols]


def numbered(rows: DataFrame, name: str = "pos") -> DataFrame:
    """``rows`` with ``name``: the place of each in its symbol from 0, in total order. A null symbol is a symbol
    like any other; the rows without a date are a year of their own, before all others."""
    # A struct, as an equality of structs holds for null fields too and needs no other partitioning than the window.
    range_ = F.expr("struct(symbol, year(Date) as year)").alias("_range")
    counts = rows.groupBy(range_).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_range.symbol").orderBy("_range.year").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.sum("_n").over(earlier).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*total_order(rows.columns)))
    placed = rows.withColumn("_range", range_).withColumn("_place", inside).join(starts, "_range")
    return placed.select(*[f"`{c}`" for c in rows.columns], F.expr(f"coalesce(_start, 0) + _place - 1 as {name}"))


def with_neighbours(rows: DataFrame, value, behind: int = 0, ahead: int = 0) -> DataFrame:
    """``rows`` with the columns of ``value(window)``, a dict of columns over a window in total order that may reach
    ``behind`` rows back and ``ahead`` rows forward (a frame or a lag within that reach).

    Blocks are at least as long as the reach, so a row goes to its own block and at most two others."""
    size = max(BLOCK_ROWS, behind, ahead)
    own = f"_pos div {size}"
    blocks = f"""
        filter(array({own}, if(_pos % {size} < {ahead}, {own} - 1, null), if(_pos % {size} >= {size - behind}, {own} + 1, null)),
               b -> b is not null)
    """
    dealt = numbered(rows, "_pos").withColumn("_block", F.explode(F.expr(blocks)))
    window = Window.partitionBy("symbol", "_block").orderBy("_pos")
    found = dealt.withColumns(value(window)).where(f"_block = {own}")
    return found.drop("_pos", "_block")
