"""Dispatch by name: ``run(bars, "return_rate_period", symbols=["AAPL"], period="y", shares=200)``; several
summaries in one job: ``run_many(bars, ["date_span", ("column_correlation", {"col1": "Open", "col2": "Close"})])``."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela import operators as ops
from candela.operators import correlation, explore

OPERATORS: dict[str, Callable[..., DataFrame]] = {name: getattr(ops, name) for name in ops.__all__}

#: Operators that are one aggregate by symbol, with the columns they aggregate.
SUMMARIES: dict[str, Callable[..., list[Column]]] = {
    "num_observations": explore.observation_columns,
    "date_span": explore.span_columns,
    "descriptive_stats": explore.stats_columns,
    "missing_counts": explore.missing_columns,
    "column_correlation": correlation.correlation_columns,
}


def _of(bars: DataFrame, symbols: Iterable[str] | None) -> DataFrame:
    """``bars`` of ``symbols`` if given; the filter is pushed to the scan when ``bars`` comes from Parquet."""
    return bars if symbols is None else bars.where(F.col("symbol").isin(list(symbols)))


def run(bars: DataFrame, op_name: str, symbols: Iterable[str] | None = None, **kwargs) -> DataFrame:
    """Run operator ``op_name`` on ``bars``, restricted to ``symbols`` when given."""
    try:
        op = OPERATORS[op_name]
    except KeyError:
        raise ValueError(f"unknown operator {op_name!r}; known: {sorted(OPERATORS)}") from None
    return op(_of(bars, symbols), **kwargs)


def run_many(bars: DataFrame, requests: Iterable[str | tuple[str, dict]], symbols: Iterable[str] | None = None) -> DataFrame:
    """Several of ``SUMMARIES`` in one read and one shuffle: ``symbol`` and, for each request, a struct named after
    the operator (``name_2``, ``name_3``, ... where it is asked for again) with the columns that ``run`` gives.

    A request is a name or (name, arguments). All aggregates are partial, so one short row per symbol and map
    task is exchanged, however many summaries are asked for."""
    bars = _of(bars, symbols)
    wanted: dict[str, list[Column]] = {}
    for request in requests:
        op_name, arguments = (request, {}) if isinstance(request, str) else request
        if op_name not in SUMMARIES:
            raise ValueError(f"not a summary by symbol: {op_name!r}; known: {sorted(SUMMARIES)}")
        times = sum(name == op_name or name.startswith(op_name + "_") for name in wanted)
        wanted[f"{op_name}_{times + 1}" if times else op_name] = SUMMARIES[op_name](bars, **arguments)
    if not wanted:
        raise ValueError("at least one summary is needed")
    return bars.groupBy("symbol").agg(*[F.struct(*columns).alias(name) for name, columns in wanted.items()])
