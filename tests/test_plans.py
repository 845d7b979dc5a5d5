"""Plan shape: partial aggregation before shuffles, no Python in the plan, windows partitioned by
symbol (never a single-partition exchange), date filters pushed into the Parquet scan."""

import os

import pytest

from candela import operators as ops
from candela.sources import load_bars, write_bars

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bars(spark):
    return load_bars(spark, SF)


@pytest.mark.parametrize(
    "build",
    [
        lambda b: ops.max_return_rate(b, "y", 200),
        lambda b: ops.stock_variation(b, "d"),
        lambda b: ops.moving_average(b, "Open", 5),
        lambda b: ops.anchored_avg_price(b, "m"),
        lambda b: ops.anchored_monthly_variation(b),
        lambda b: ops.correlation_between(b, [("1-URGENT", "2-HIGH")]),
        lambda b: ops.head_and_tail(b),
    ],
)
def test_no_python_and_no_single_partition(spark, bars, build):
    plan = _final_plan(build(bars))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "SinglePartition", "CartesianProduct"):
        assert bad not in plan, bad


def test_flagship_aggregates_partially_before_shuffle(spark, bars):
    plan = _plan(ops.max_return_rate(bars, "y", 200))
    # the per-year representative bar is a partial + final aggregate around one exchange
    assert plan.count("ObjectHashAggregate") + plan.count("HashAggregate") + plan.count("SortAggregate") >= 4
    assert "partial_max_by" in plan


def test_date_filter_reaches_parquet_scan(spark, sample, scratch):
    path = os.path.join(scratch, "bars_for_pushdown")
    write_bars(sample, path)
    stored = spark.read.parquet(path)
    plan = _plan(ops.avg_price_until(stored, "2020-01-01", "2020-12-31", "Open"))
    assert "PushedFilters: [IsNotNull(Date), GreaterThanOrEqual(Date,2020-01-01), LessThanOrEqual(Date,2020-12-31)]" in plan
    # only the needed columns are read
    assert "ReadSchema: struct<symbol:string,Date:date,Open:double>" in plan


def test_anchored_operators_read_once(spark, bars):
    plan = _plan(ops.anchored_volume_variation(bars, "m"))
    plan = plan[plan.index("Initial Plan"):] if "Initial Plan" in plan else plan
    assert plan.count("FileScan") == 2  # orders and lineitem, once each
    assert "REPARTITION_BY_NUM" not in plan and "BatchEvalPython" not in plan


def test_symbol_filter_of_run_reaches_parquet_scan(spark, sample, scratch):
    from candela.plans import run

    path = os.path.join(scratch, "bars_for_symbol_pushdown")
    write_bars(sample, path)
    plan = _plan(run(spark.read.parquet(path), "num_observations", symbols=["test", "other"]))
    assert "In(symbol, [other,test])" in plan
