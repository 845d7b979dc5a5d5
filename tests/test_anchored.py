"""Anchored-period operators against a plain sequential restatement of the rules, on many random
series held in one DataFrame (which also checks that symbols do not leak into each other)."""

import datetime as dt
import random

import pytest

from candela import operators as ops
from tests.conftest import make_bars

DAYS = {"w": 7, "m": 30, "y": 365}


def _series(seed):
    rnd = random.Random(seed)
    n = rnd.randint(1, 25)
    day = dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 40))
    rows = []
    for _ in range(n):
        o = round(rnd.uniform(10, 20), 2)
        c = round(rnd.uniform(10, 20), 2)
        rows.append((day, o, c, rnd.randint(100, 999)))
        day += dt.timedelta(days=rnd.choice([1, 1, 2, 3, 5, 8, 13, 29, 31, 45, 70]))
    return rows


def _anchors(rows, n):
    found = [0]
    for i in range(1, len(rows)):
        if (rows[i][0] - rows[found[-1]][0]).days >= n:
            found.append(i)
    return found


def _expected_avg(rows, n, value):
    anchors = _anchors(rows, n)
    out = []
    for k in range(1, len(anchors)):
        lo = anchors[k - 1] if k == 1 else anchors[k - 1] + 1
        seg = [value(r) for r in rows[lo : anchors[k]]]
        start, end = rows[anchors[k - 1]][0], rows[anchors[k]][0]
        out.append((start, end, sum(seg) / len(seg) if seg else None))
    return out


def _expected_rate(rows, n):
    a = _anchors(rows, n)
    return [(rows[a[k - 1]][0], rows[a[k]][0], (rows[a[k]][2] - rows[a[k - 1]][1]) / rows[a[k - 1]][1] * 100) for k in range(1, len(a))]


def _expected_volume(rows, n):
    a = _anchors(rows, n)
    out = {rows[a[k]][0]: rows[a[k]][3] - rows[a[k - 1]][3] for k in range(1, len(a))}
    last = len(rows) - 1
    if last not in a[1:]:
        out[rows[last][0]] = rows[last][3] - rows[a[-1]][3]
    return out


def _expected_monthly(rows, limit=None, n=30):
    a = _anchors(rows, n)
    out = {}
    for k in range(1, len(a)):
        if limit is not None and k > limit:
            break
        out[rows[a[k]][0]] = rows[a[k]][2] - rows[a[k - 1]][1]
    boundaries = len(a) - 1
    if limit is None or boundaries < limit:
        last = len(rows) - 1
        in_force = max(i for i in a if i <= last)
        out[rows[last][0]] = rows[last][2] - rows[in_force][1]
    return out


@pytest.fixture(scope="module")
def random_bars(spark):
    data = {f"s{i:02d}": _series(i) for i in range(40)}
    rows = [(s, d.isoformat(), o, c, v) for s, series in data.items() for d, o, c, v in series]
    return data, make_bars(spark, rows).cache()


def _collect(df, *cols):
    res = {}
    for r in df.collect():
        res.setdefault(r.symbol, []).append(tuple(r[c] for c in cols))
    return res


@pytest.mark.parametrize("period", ["w", "m", "y"])
def test_anchored_avg_price(random_bars, period):
    data, bars = random_bars
    got = _collect(ops.anchored_avg_price(bars, period, "Open", digits=None), "Period", "Average_Open_Price($)")
    for sym, rows in data.items():
        want = [(end, avg) for _, end, avg in _expected_avg(rows, DAYS[period], lambda r: r[1])]
        have = sorted(got.get(sym, []))
        assert [d for d, _ in have] == [d for d, _ in want], sym
        for (_, h), (_, w) in zip(have, want):
            assert (h is None and w is None) or h == pytest.approx(w), sym


@pytest.mark.parametrize("period", ["w", "m"])
def test_anchored_avg_return(random_bars, period):
    data, bars = random_bars
    got = _collect(ops.anchored_avg_return(bars, period, digits=None), "Period", "Average_Stock_Variation_($)")
    for sym, rows in data.items():
        want = sorted((f"{s} to {e}", v) for s, e, v in _expected_avg(rows, DAYS[period], lambda r: r[2] - r[1]))
        have = sorted(got.get(sym, []))
        assert [p for p, _ in have] == [p for p, _ in want], sym
        for (_, h), (_, w) in zip(have, want):
            assert (h is None and w is None) or h == pytest.approx(w), sym


@pytest.mark.parametrize("period", ["w", "m", "y"])
def test_anchored_return_rate_and_max(random_bars, period):
    data, bars = random_bars
    got = _collect(ops.anchored_return_rate(bars, period), "Period", "Return_Rate_(%)")
    top = {r.symbol: r.Max_Return_Rate for r in ops.anchored_max_return_rate(bars, period).collect()}
    for sym, rows in data.items():
        want = sorted((f"{s} to {e}", v) for s, e, v in _expected_rate(rows, DAYS[period]))
        have = sorted(got.get(sym, []))
        assert [p for p, _ in have] == [p for p, _ in want]
        assert [v for _, v in have] == pytest.approx([v for _, v in want])
        if want:
            assert top[sym] == pytest.approx(max(v for _, v in want))
        else:
            assert sym not in top


@pytest.mark.parametrize("period", ["w", "m", "y"])
def test_anchored_volume_variation(random_bars, period):
    data, bars = random_bars
    got = _collect(ops.anchored_volume_variation(bars, period), "Period", "Variation_Volume")
    for sym, rows in data.items():
        assert dict(got[sym]) == _expected_volume(rows, DAYS[period]), sym


@pytest.mark.parametrize("limit", [None, 1, 2, 3, 0])
def test_anchored_monthly_variation(random_bars, limit):
    data, bars = random_bars
    got = _collect(ops.anchored_monthly_variation(bars, limit, digits=None), "Period", "Stock_Variation_($)")
    for sym, rows in data.items():
        want = _expected_monthly(rows, None if limit == 0 else limit)
        have = dict(got.get(sym, []))
        assert sorted(have) == sorted(want), sym
        for d in want:
            assert have[d] == pytest.approx(want[d]), (sym, d)


def test_sparse_series_gives_empty_segments(spark):
    bars = make_bars(spark, [("S", d, o, o) for d, o in (("2020-01-01", 1.0), ("2020-02-15", 2.0), ("2020-04-01", 3.0))])
    got = sorted((r.Period, r["Average_Open_Price($)"]) for r in ops.anchored_avg_price(bars, "w").collect())
    assert got == [(dt.date(2020, 2, 15), 1.0), (dt.date(2020, 4, 1), None)]


def test_last_row_boundary_overwrites_only_without_limit(spark):
    rows = [("S", "2020-01-01", 10.0, 11.0), ("S", "2020-02-01", 20.0, 25.0)]
    bars = make_bars(spark, rows)
    free = {r.Period: r["Stock_Variation_($)"] for r in ops.anchored_monthly_variation(bars).collect()}
    assert free == {dt.date(2020, 2, 1): 5.0}
    capped = {r.Period: r["Stock_Variation_($)"] for r in ops.anchored_monthly_variation(bars, 1).collect()}
    assert capped == {dt.date(2020, 2, 1): 15.0}


def test_single_row_and_rounding(spark):
    one = make_bars(spark, [("S", "2020-01-01", 1.0, 1.23456, 5)])
    assert ops.anchored_avg_price(one, "m").count() == 0
    assert [(r.Variation_Volume) for r in ops.anchored_volume_variation(one, "m").collect()] == [0]
    assert [r["Stock_Variation_($)"] for r in ops.anchored_monthly_variation(one).collect()] == [0.235]


def test_bad_arguments(spark):
    one = make_bars(spark, [("S", "2020-01-01", 1.0, 2.0)])
    with pytest.raises(ValueError):
        ops.anchored_avg_price(one, "q")
    with pytest.raises(ValueError):
        ops.anchored_avg_price(one, "m", "Volume")
    with pytest.raises(ValueError):
        ops.anchored_volume_variation(one, "d")


def test_boundary_at_exactly_n_days(spark):
    start = dt.date(2021, 3, 1)
    offsets = [0, 6, 7, 13, 14, 20, 21, 27]
    rows = [("S", (start + dt.timedelta(days=o)).isoformat(), float(o + 1), float(o + 2)) for o in offsets]
    bars = make_bars(spark, rows)
    anchors = sorted(r.Date for r in ops.mark_anchors(bars, 7).where("k >= 0").collect())
    assert anchors == [start + dt.timedelta(days=o) for o in (0, 7, 14, 21)]
    periods = sorted(r.Period for r in ops.anchored_return_rate(bars, "w").collect())
    assert periods == [
        f"{start + dt.timedelta(days=a)} to {start + dt.timedelta(days=b)}" for a, b in ((0, 7), (7, 14), (14, 21))
    ]
    # segment 0 = days 0 and 6; later segments hold only the day after each anchor but one (13, 20)
    avgs = sorted((r.Period, r["Average_Open_Price($)"]) for r in ops.anchored_avg_price(bars, "w", digits=None).collect())
    assert [v for _, v in avgs] == [4.0, 14.0, 21.0]


def test_repeated_dates_and_null_symbols(spark):
    days = ["2020-01-01", "2020-01-15", "2020-02-15", "2020-02-15", "2020-04-01"]
    rows = [(sym, d, float(i + 1), float(i + 2)) for sym in ("S", None) for i, d in enumerate(days)]
    bars = make_bars(spark, rows)
    got = _collect(ops.anchored_return_rate(bars, "m"), "Period")
    want = [("2020-01-01 to 2020-02-15",), ("2020-02-15 to 2020-04-01",)]
    assert {k: sorted(v) for k, v in got.items()} == {"S": want, None: want}
    # the segment of 2020-04-01 holds the second row of 2020-02-15
    avgs = _collect(ops.anchored_avg_price(bars, "m", digits=None), "Period", "Average_Open_Price($)")
    assert [v for _, v in sorted(avgs["S"])] == [1.5, 4.0]


def test_rows_without_a_date_stay(spark):
    bars = make_bars(spark, [("S", None, 2.0, 3.0), ("S", "2020-01-01", 1.0, 2.0), ("S", "2020-01-02", 4.0, 2.0)])
    for df in (ops.period_return(bars, "d"), ops.return_rate_period(bars, "d", 200), ops.moving_average(bars), ops.stock_variation(bars)):
        assert df.count() == 3
    assert ops.head_and_tail(bars, 1).count() == 2 and ops.head_and_tail(bars, 2).count() == 4
    assert {(r.year, r.Average_Price) for r in ops.avg_price_period(bars, "y").collect()} == {(0, 2.0), (2020, 2.5)}
    assert {(r.year_nb, r.Yearly_Return) for r in ops.avg_return(bars, "y").collect()} == {(0, 50.0), (2020, 25.0)}


def _long_series(spark, days, copies=1):
    """One symbol with ``copies`` equal rows on each of ``days`` successive days."""
    rows = spark.range(0, days * copies, 1, 8).selectExpr("cast(id div %d as int) as d" % copies)
    return rows.selectExpr(
        "'S' as symbol", "date_add(date'0001-01-01', d) as Date", "double(d) as Open", "double(d + 1) as Close", "bigint(d) as Volume"
    )


def test_one_symbol_of_a_million_rows(spark):
    bars = _long_series(spark, 250_001, 4)  # 684 years
    got = ops.anchored_volume_variation(bars, "w").groupBy("Variation_Volume").count().collect()
    assert {r.Variation_Volume: r["count"] for r in got} == {7: 35_714, 2: 1}
    rates = ops.anchored_return_rate(bars, "y").selectExpr("count(*) n", "min(Period) first", "max(`Return_Rate_(%)`) top").first()
    assert (rates.n, rates.first, rates.top) == (250_000 // 365, "0001-01-01 to 0002-01-01", pytest.approx((731 - 365) / 365 * 100))


def test_rows_of_one_day_are_summed_up_before_a_symbol_meets(spark):
    bars = _long_series(spark, 40, 5000)
    got = sorted((r.Period, r["Average_Open_Price($)"]) for r in ops.anchored_avg_price(bars, "m", digits=None).collect())
    # the one segment: all rows of days 0 to 29
    assert got == [(dt.date(1, 1, 31), pytest.approx(14.5))]
    plan = ops.anchored_avg_price(bars, "m")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("collect_list") == 2  # partial and final, of days that were summed up
    assert plan.index("collect_list") < plan.rindex("partial_min(struct(Open")  # printed from the top: after the sums


def test_path_equals_a_walk_over_the_days(spark):
    rng = random.Random(12)
    for n in (1, 2, 7, 30):
        rows, want = [], {}
        for s in range(8):
            days = sorted(rng.sample(range(5000), rng.randint(1, 400)))
            path = [days[0]]
            for d in days:
                if d - path[-1] >= n:
                    path.append(d)
            want[f"S{s}"] = path
            rows += [(f"S{s}", (dt.date(2000, 1, 1) + dt.timedelta(days=d)).isoformat(), 1.0, 2.0) for d in days]
        marked = ops.mark_anchors(make_bars(spark, rows), n).collect()
        got = {s: sorted((r.Date - dt.date(2000, 1, 1)).days for r in marked if r.symbol == s and r.k >= 0) for s in want}
        assert got == want and len(marked) == len(rows)
        assert all(r.n_anchors == len(want[r.symbol]) for r in marked) and sum(r.is_last for r in marked) == len(want)
