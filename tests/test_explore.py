import datetime as dt
import math

import pytest

from candela import operators as ops
from tests.conftest import make_bars

D = dt.date


def test_counts_and_span_golden(sample):
    assert ops.num_observations(sample).first().num_observations == 17
    r = ops.date_span(sample).first()
    assert (r.first_date, r.last_date, r.span_days) == (D(2018, 7, 9), D(2023, 6, 16), 1803)


def test_head_and_tail_overlap_on_short_series(spark):
    rows = [("S", (D(2020, 1, 1) + dt.timedelta(days=i)).isoformat(), float(i), float(i)) for i in range(50)]
    out = ops.head_and_tail(make_bars(spark, rows)).collect()
    assert len(out) == 80
    days = sorted(r.Date for r in out)
    assert days.count(D(2020, 1, 20)) == 2 and days.count(D(2020, 1, 1)) == 1


def test_head_and_tail_long_series(spark):
    rows = [("S", (D(2020, 1, 1) + dt.timedelta(days=i)).isoformat(), float(i), float(i)) for i in range(100)]
    out = sorted(r.Open for r in ops.head_and_tail(make_bars(spark, rows)).collect())
    assert out == [float(i) for i in range(40)] + [float(i) for i in range(60, 100)]


def test_most_common_day_first_seen_wins_ties(spark):
    days = ["2020-01-05", "2020-02-09", "2020-03-09", "2020-04-05"]
    r = ops.most_common_day(make_bars(spark, [("S", d, 1.0, 1.0) for d in days])).first()
    assert (r.day, r.occurrences) == (5, 2)


def test_descriptive_stats_golden(sample):
    r = ops.descriptive_stats(sample).first().asDict()
    assert r["min_Date"] == D(2018, 7, 9) and r["max_Date"] == D(2023, 6, 16)
    assert r["max_Open"] == pytest.approx(61.0917)
    assert r["stddev_Stock Splits"] == 0.0
    assert "stddev_Date" not in r
    assert r["min_Volume"] == 11875320


def test_missing_counts_null_and_nan(spark):
    rows = [
        ("S", "2020-01-01", None, 1.0, 10),
        ("S", "2020-01-02", 1.0, float("nan"), None),
        ("S", None, 1.0, 2.0, 5),
    ]
    r = ops.missing_counts(make_bars(spark, rows)).first()
    assert (r.missing_Open, r.missing_Close, r.missing_Volume, r.missing_Date) == (1, 1, 1, 1)
    assert ops.num_observations(make_bars(spark, rows)).first().num_observations == 3


def test_sampling_frequency(spark, sample):
    weekly = [("W", (D(2020, 1, 6) + dt.timedelta(days=7 * i)).isoformat(), 1.0, 1.0) for i in range(10)]
    monthly = [("M", f"2020-{m:02d}-01", 1.0, 1.0) for m in range(1, 13)]
    got = {r.symbol: r.frequency for r in ops.sampling_frequency(make_bars(spark, weekly + monthly)).collect()}
    assert got == {"W": "weekly", "M": "monthly"}
    assert ops.sampling_frequency(sample).first().frequency == "daily"


def test_month_labels(spark):
    bars = make_bars(spark, [("S", "2024-09-03", 1.0, 1.0), ("S", "2024-01-31", 1.0, 1.0), ("S", None, 1.0, 1.0)])
    got = sorted((str(r.Date), r.Month_Label) for r in ops.with_month_label(bars).collect())
    assert got == [("2024-01-31", "Jan-2024"), ("2024-09-03", "Sept-2024"), ("None", None)]


def test_intraday_and_latest_average(spark, sample):
    iv = {r.Date: r.Stock_Variation for r in ops.intraday_variation(sample).collect()}
    assert iv[D(2019, 3, 18)] == pytest.approx(29.976)
    assert ops.max_daily_return(sample).first().Maximum_profit == pytest.approx(29.976)
    latest = ops.latest_average(sample, "Open", 3).collect()
    assert sorted(r.Date for r in latest) == [D(2023, 6, 14), D(2023, 6, 15), D(2023, 6, 16)]
    assert {r.Moving_Average for r in latest} == {round((55.6642 + 61.0917 + 52.4436) / 3, 3)}
    assert not math.isnan(latest[0].Moving_Average)
