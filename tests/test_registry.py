import pytest

from candela.plans import OPERATORS, run
from tests.conftest import make_bars


def test_run_by_name_with_symbol_filter(spark):
    bars = make_bars(spark, [("A", "2020-01-01", 1.0, 2.0), ("B", "2020-01-01", 1.0, 3.0)])
    out = run(bars, "return_rate_period", symbols=["B"], period="d", shares=10).collect()
    assert [(r.symbol, r["Return_Rate(%)"]) for r in out] == [("B", pytest.approx(200.0))]
    assert "anchored_volume_variation" in OPERATORS


def test_unknown_operator(spark):
    bars = make_bars(spark, [("A", "2020-01-01", 1.0, 2.0)])
    with pytest.raises(ValueError):
        run(bars, "no_such_operator")


def test_many_summaries_in_one_read_equal_the_operators(spark):
    from candela import operators as ops
    from candela.plans import SUMMARIES, run_many
    from candela.plans.catalog import with_gaps
    from candela.sources import load_bars

    bars = with_gaps(load_bars(spark, "/root/testdata/sf0.001")).cache()
    pair = {"col1": "Open", "col2": "High"}
    requests = [(n, pair if n == "column_correlation" else {}) for n in SUMMARIES] + [("column_correlation", pair | {"nulls": "drop"})]
    many = run_many(bars, requests)
    got = {r.symbol: r for r in many.collect()}
    assert many.columns == ["symbol", *SUMMARIES, "column_correlation_2"]
    for name, kwargs in requests[:-1]:
        for r in run(bars, name, **kwargs).collect():
            assert repr(tuple(r)[1:]) == repr(tuple(got[r.symbol][name])), name
    for r in ops.column_correlation(bars, **pair, nulls="drop").collect():
        assert repr(r.correlation) == repr(got[r.symbol]["column_correlation_2"].correlation)


def test_many_summaries_share_one_scan(spark):
    from candela.plans import SUMMARIES, run_many
    from candela.sources import load_bars

    bars = load_bars(spark, "/root/testdata/sf0.001")
    df = run_many(bars, [n for n in SUMMARIES if n != "column_correlation"], symbols=["1-URGENT"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.index("Initial Plan"):] if "Initial Plan" in plan else plan
    assert plan.count("FileScan") == 2  # orders and lineitem
    with pytest.raises(ValueError):
        run_many(bars, ["moving_average"])
    with pytest.raises(ValueError):
        run_many(bars, [])
