import datetime as dt

import pytest
from pyspark.sql import functions as F

from candela import operators as ops
from tests.conftest import by_symbol, make_bars

D = dt.date


def _pairs(df, key, value):
    return [(r[key], r[value]) for r in df.orderBy(key).collect()]


def test_flagship_yearly_return_rate_golden(sample):
    got = _pairs(ops.return_rate_period(sample, "y", 200), "Date", "Return_Rate(%)")
    want = [
        (D(2018, 10, 15), 39.012),
        (D(2019, 7, 22), 0.0),
        (D(2020, 12, 27), 0.1934),
        (D(2021, 4, 7), -0.9009),
        (D(2022, 5, 16), 1.3273),
        (D(2023, 6, 16), -4.6482),
    ]
    assert [d for d, _ in got] == [d for d, _ in want]
    for (_, g), (_, w) in zip(got, want):
        assert g == pytest.approx(w, abs=1e-4)
    top = ops.max_return_rate(sample, "y", 200).collect()
    assert top[0]["Max_Return_Rate"] == pytest.approx(39.012, abs=1e-4)


def test_yearly_variation_golden(sample):
    got = [v for _, v in _pairs(ops.stock_variation(sample, "y"), "Date", "Variation_Open_Price")]
    assert got == pytest.approx([0.0, 1.7592, 1.1679, 2.7196, 0.7873, 4.1061], abs=1e-4)


def test_yearly_average_open_golden(sample):
    got = [v for _, v in _pairs(ops.avg_price_period(sample, "y", "Open"), "year", "Average_Price")]
    assert got == pytest.approx([41.6861, 42.1524, 44.6516, 46.9111, 47.6645, 54.8301], abs=1e-4)


def test_average_until_golden(sample):
    row = ops.avg_price_until(sample, "2019-01-01", "2019-12-31", "Open").collect()[0]
    assert row["Average_Open_Price_($)"] == pytest.approx(42.1524, abs=1e-6)


def test_forward_moving_average_golden(sample):
    got = _pairs(ops.moving_average(sample, "Open", 3), "Date", "Moving_Average")[-3:]
    assert [d for d, _ in got] == [D(2023, 6, 14), D(2023, 6, 15), D(2023, 6, 16)]
    assert [v for _, v in got] == pytest.approx([56.3998, 56.7677, 52.4436], abs=1e-4)


def test_week_one_joins_calendar_year(spark):
    bars = make_bars(spark, [("S", d, 10.0, 11.0) for d in ("2019-01-02", "2019-12-30", "2019-12-31", "2020-01-02")])
    got = sorted((r.week_nb, r.year, r.n) for r in ops.avg_price_period(bars, "w").withColumn("n", F.lit(1)).collect())
    assert [(w, y) for w, y, _ in got] == [(1, 2019), (1, 2020)]
    rep = sorted((r.week_nb, r.year_nb, r.Date) for r in ops.last_bar(bars, "w").collect())
    assert rep == [(1, 2019, D(2019, 12, 31)), (1, 2020, D(2020, 1, 2))]


def test_zero_open_gives_zero_return(spark):
    bars = make_bars(spark, [("S", "2020-01-01", 0.0, 5.0), ("S", "2020-01-02", 2.0, 3.0)])
    got = _pairs(ops.period_return(bars, "d"), "Date", "Daily_Return")
    assert got == [(D(2020, 1, 1), 0.0), (D(2020, 1, 2), 50.0)]
    rr = _pairs(ops.return_rate(bars, "2020-01-01", "2020-01-02", 10), "Date", "Return_Rate(%)")
    assert rr[0][1] is None  # the range operator does not fill


def test_representative_row_is_latest_day(spark):
    bars = make_bars(spark, [("S", "2020-01-05", 1.0, 2.0), ("S", "2020-01-20", 3.0, 4.0), ("S", "2020-02-03", 5.0, 6.0)])
    got = ops.period_return(bars, "m").orderBy("Date").collect()
    assert [(r.Date, r.Open, r["Close(M+1)"], r.Benefit) for r in got] == [
        (D(2020, 1, 20), 3.0, 6.0, 100.0),
        (D(2020, 2, 3), 5.0, 0.0, 0.0),
    ]
    weekly = ops.return_rate_period(bars, "m", 10).orderBy("Date").collect()
    assert [(r.month_nb, r["Open(M+1)"]) for r in weekly] == [(1, 0.0), (2, 3.0)]
    assert weekly[1]["Return_Rate(%)"] == pytest.approx((3.0 - 5.0) / 5.0 * 100)


def test_average_return_fills_before_averaging(spark):
    bars = make_bars(spark, [("S", "2020-01-01", 0.0, 5.0), ("S", "2020-01-02", 2.0, 3.0)])
    row = ops.avg_return(bars, "m").collect()[0]
    assert row.Monthly_Return == pytest.approx(25.0)


def test_filter_runs_before_window(spark):
    bars = make_bars(spark, [("S", f"2020-0{m}-15", float(m), float(m)) for m in range(1, 7)])
    got = _pairs(ops.stock_variation_until(bars, "2020-03-01", "2020-05-31", "m"), "Date", "Variation_Open_Price")
    assert [v for _, v in got] == [0.0, 1.0, 1.0]


def test_daily_variation_sums_to_net_change(spark):
    rows = [("A", f"2021-03-{d:02d}", 10.0 + d * 0.37, 1.0) for d in range(1, 29)] + [("B", "2021-03-01", 5.0, 1.0)]
    bars = make_bars(spark, rows)
    total = by_symbol(ops.stock_variation(bars, "d").groupBy("symbol").agg(F.sum("Variation_Open_Price").alias("t")))
    assert total["A"][0]["t"] == pytest.approx(27 * 0.37)
    assert total["B"][0]["t"] == 0.0


def test_daily_rate_equals_daily_return_and_ignores_shares(spark, sample):
    a = {r.Date: r["Return_Rate(%)"] for r in ops.return_rate_period(sample, "d", 7).collect()}
    b = {r.Date: r.Daily_Return for r in ops.period_return(sample, "d").collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], rel=1e-9)


def test_moving_average_of_one_is_the_field(sample):
    for r in ops.moving_average(sample, "Close", 1).collect():
        assert r.Moving_Average == r.Close


def test_results_independent_of_other_symbols_and_partitioning(spark, sample):
    alone = sorted(map(tuple, ops.return_rate_period(sample, "m", 200).collect()))
    other = make_bars(spark, [("other", "2020-01-01", 1.0, 2.0), ("other", "2020-02-01", 3.0, 4.0)])
    mixed = sample.unionByName(other).repartition(7)
    together = sorted(map(tuple, ops.return_rate_period(mixed, "m", 200).where("symbol = 'test'").collect()))
    assert alone == together


def test_dividend_revenue(sample):
    r = ops.dividend_return(sample, 10).orderBy("Date").first()
    assert r.Revenues == pytest.approx(5200.0)
    assert "Revenus" in ops.dividend_return(sample, 2, output_col="Revenus").columns


def test_max_return_per_period(sample):
    d = ops.max_return(sample, "d").first().Max_Return
    assert d == pytest.approx(max(r.Daily_Return for r in ops.period_return(sample, "d").collect()))
    y = ops.max_return(sample, "y").first().Max_Return
    assert y == pytest.approx(max(r.Benefit for r in ops.period_return(sample, "y").collect()))


@pytest.mark.parametrize(
    "call",
    [
        lambda b: ops.avg_price_period(b, "d"),
        lambda b: ops.avg_return(b, "d"),
        lambda b: ops.period_return(b, "q"),
        lambda b: ops.return_rate_period(b, "x", 1),
        lambda b: ops.stock_variation(b, "z"),
    ],
)
def test_bad_period_codes_raise(sample, call):
    with pytest.raises(ValueError):
        call(sample)


def test_empty_and_single_row(spark):
    empty = make_bars(spark, [])
    one = make_bars(spark, [("S", "2020-01-01", 1.0, 2.0)])
    for p in "dwmy":
        assert ops.return_rate_period(empty, p, 5).count() == 0
        assert ops.return_rate_period(one, p, 5).count() == 1
        assert ops.period_return(one, p).count() == 1
        assert ops.stock_variation(one, p).first().Variation_Open_Price == 0.0
    assert ops.moving_average(one, "Open", 5).first().Moving_Average == 1.0


def test_iso_year_option_moves_week_one(spark):
    bars = make_bars(spark, [("S", d, 10.0, 11.0) for d in ("2019-01-02", "2019-12-30", "2019-12-31", "2020-01-02")])
    got = sorted((r.week_nb, r.year) for r in ops.avg_price_period(bars, "w", iso_year=True).collect())
    assert got == [(1, 2019), (1, 2020)]
    counts = {
        (r.week_nb, r.year_nb): r.Date for r in ops.last_bar(bars, "w", iso_year=True).collect()
    }
    assert counts == {(1, 2019): D(2019, 1, 2), (1, 2020): D(2020, 1, 2)}
    assert ops.return_rate_period(bars, "w", 10, iso_year=True).count() == 2


def test_newest_first(spark, sample):
    from candela.functions import newest_first

    got = [(r.year, r.month_nb) for r in newest_first(ops.avg_price_period(sample, "m")).collect()]
    assert got == sorted(got, reverse=True)
    days = [r.Date for r in newest_first(ops.period_return(sample, "y")).collect()]
    assert days == sorted(days, reverse=True)
    with pytest.raises(ValueError):
        newest_first(ops.num_observations(sample))
