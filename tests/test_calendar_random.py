"""Calendar operators against a plain restatement of their rules, on random multi-symbol series with
missing prices and zero opens."""

import datetime as dt
import random

import pytest

from candela import operators as ops
from tests.conftest import make_bars


def _series(seed):
    rnd = random.Random(1000 + seed)
    day = dt.date(2018, 12, 20) + dt.timedelta(days=rnd.randint(0, 30))
    rows = []
    for _ in range(rnd.randint(1, 60)):
        o = rnd.choice([None, 0.0] + [round(rnd.uniform(5, 50), 2)] * 12)
        c = rnd.choice([None] + [round(rnd.uniform(5, 50), 2)] * 12)
        rows.append((day, o, c))
        day += dt.timedelta(days=rnd.choice([1, 1, 1, 2, 3, 6, 11, 40]))
    return rows


def _key(period, d):
    if period == "w":
        return (d.isocalendar()[1], d.year)
    if period == "m":
        return (d.month, d.year)
    return (d.year,)


def _pct(i, c):
    if i is None or c is None or i == 0:
        return None
    return (c - i) / i * 100


def _rep(rows, period):
    groups = {}
    for d, o, c in rows:
        groups.setdefault(_key(period, d), []).append((d, o, c))
    return sorted(max(g) for g in groups.values())


@pytest.fixture(scope="module")
def random_bars(spark):
    data = {f"r{i:02d}": _series(i) for i in range(30)}
    rows = [(s, d.isoformat(), o, c) for s, series in data.items() for d, o, c in series]
    return data, make_bars(spark, rows).cache()


def _close(a, b):
    return (a is None and b is None) or (a is not None and b is not None and a == pytest.approx(b, rel=1e-9, abs=1e-9))


@pytest.mark.parametrize("period", ["w", "m", "y"])
def test_avg_price_and_avg_return(random_bars, period):
    data, bars = random_bars
    prices = {(r.symbol,) + tuple(r[k] for k in r.__fields__[1:-1]): r.Average_Price for r in ops.avg_price_period(bars, period).collect()}
    returns = {(r.symbol,) + tuple(r[k] for k in r.__fields__[1:-1]): r[r.__fields__[-1]] for r in ops.avg_return(bars, period).collect()}
    for sym, rows in data.items():
        groups = {}
        for d, o, c in rows:
            groups.setdefault(_key(period, d), []).append((o, c))
        for key, vals in groups.items():
            opens = [o for o, _ in vals if o is not None]
            want_price = sum(opens) / len(opens) if opens else 0.0
            daily = [(_pct(o, c) or 0.0) for o, c in vals]
            want_ret = sum(daily) / len(daily)
            assert _close(prices[(sym,) + key], want_price), (sym, key)
            assert _close(returns[(sym,) + key], want_ret), (sym, key)


@pytest.mark.parametrize("period", ["d", "w", "m", "y"])
def test_variation_returns_and_rates(random_bars, period):
    data, bars = random_bars
    var = {(r.symbol, r.Date): r.Variation_Open_Price for r in ops.stock_variation(bars, period).collect()}
    ret_col = "Daily_Return" if period == "d" else "Benefit"
    ret = {(r.symbol, r.Date): r[ret_col] for r in ops.period_return(bars, period).collect()}
    rate = {(r.symbol, r.Date): r["Return_Rate(%)"] for r in ops.return_rate_period(bars, period, 7).collect()}
    for sym, rows in data.items():
        series = rows if period == "d" else _rep(rows, period)
        for i, (d, o, c) in enumerate(series):
            prev_open = series[i - 1][1] if i else None
            want_var = 0.0 if (o is None or prev_open is None) else o - prev_open
            assert _close(var[(sym, d)], want_var), (sym, d)
            if period == "d":
                want_ret = _pct(o, c) or 0.0
                want_rate = _pct(None if o is None else o * 7, None if c is None else c * 7) or 0.0
            else:
                next_close = series[i + 1][2] if i + 1 < len(series) else None
                want_ret = _pct(o, next_close) or 0.0
                target = c if period == "y" else prev_open
                want_rate = _pct(None if o is None else o * 7, None if target is None else target * 7) or 0.0
            assert _close(ret[(sym, d)], want_ret), (sym, d)
            assert _close(rate[(sym, d)], want_rate), (sym, d)
        assert len([k for k in var if k[0] == sym]) == len(series)


def test_moving_latest_and_head_tail(random_bars):
    data, bars = random_bars
    mov = {(r.symbol, r.Date): r.Moving_Average for r in ops.moving_average(bars, "Open", 4).collect()}
    latest = {}
    for r in ops.latest_average(bars, "Open", 3, digits=None).collect():
        latest.setdefault(r.symbol, []).append((r.Date, r.Moving_Average))
    ends = {}
    for r in ops.head_and_tail(bars, 5).collect():
        ends.setdefault(r.symbol, []).append(r.Date)
    for sym, rows in data.items():
        for i, (d, _, _) in enumerate(rows):
            frame = [o for _, o, _ in rows[i : i + 4] if o is not None]
            assert _close(mov[(sym, d)], sum(frame) / len(frame) if frame else 0.0), (sym, d)
        newest = rows[-3:]
        opens = [o for _, o, _ in newest if o is not None]
        want = sum(opens) / len(opens) if opens else None
        assert sorted(d for d, _ in latest[sym]) == [d for d, _, _ in newest]
        assert all(_close(v, want) for _, v in latest[sym]), sym
        dates = [d for d, _, _ in rows]
        assert sorted(ends[sym]) == sorted(dates[:5] + dates[-5:]), sym
