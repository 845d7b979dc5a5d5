"""Total order, distributed row numbers, halo windows, two-sided top-n: results do not depend on row order."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from candela import operators as ops
from candela.operators import positions
from candela.plans.catalog import spark_queries, with_gaps
from candela.sources import load_bars
from tests.conftest import make_bars

SF = "/root/testdata/sf0.001"


def key(row):
    return tuple((v is not None, v) for v in row)


def messy_rows(n=260, seed=2):
    """Repeated and missing dates, a null symbol, equal rows, a series over many years."""
    rng = random.Random(seed)
    rows = []
    for symbol in ("A", "B", None):
        for _ in range(n):
            day = None if rng.random() < 0.03 else f"{rng.randint(1990, 2020)}-0{rng.randint(1, 9)}-1{rng.randint(0, 3)}"
            rows.append((symbol, day, float(rng.randint(1, 4)), float(rng.randint(1, 3)), rng.randint(1, 2)))
    return rows + rows[:5]


@pytest.fixture(scope="module")
def messy(spark):
    return make_bars(spark, messy_rows()).cache()


def series(bars):
    """Rows by symbol in total order."""
    out = {}
    for r in bars.collect():
        out.setdefault(r.symbol, []).append(tuple(r)[1:])
    return {s: sorted(rows, key=key) for s, rows in out.items()}


def test_places_count_from_the_first_row_of_each_symbol(messy):
    got = {}
    for r in positions.numbered(messy).collect():
        got.setdefault(r.symbol, []).append((r.pos, tuple(r)[1:-1]))
    assert {s: [row for _, row in sorted(rows, key=lambda x: x[0])] for s, rows in got.items()} == series(messy)
    assert all(sorted(p for p, _ in rows) == list(range(len(rows))) for rows in got.values())


@pytest.mark.parametrize("block,n", [(1, 1), (3, 2), (3, 7), (50, 20), (4096, 5)])
def test_windows_over_blocks_equal_windows_over_the_series(messy, monkeypatch, block, n):
    monkeypatch.setattr(positions, "BLOCK_ROWS", block)
    want = Counter()
    for s, rows in series(messy).items():
        opens = [r[1] for r in rows]
        want.update((s, r[0], r[1], sum(opens[i : i + n]) / len(opens[i : i + n])) for i, r in enumerate(rows))
    got = ops.moving_average(messy, "Open", n)
    assert Counter((r.symbol, r.Date, r.Open, r.Moving_Average) for r in got.collect()) == pytest.approx(want)
    assert got.columns == [*messy.columns, "Moving_Average"]


@pytest.mark.parametrize("block", [1, 5, 4096])
def test_change_against_the_row_before_over_blocks(messy, monkeypatch, block):
    monkeypatch.setattr(positions, "BLOCK_ROWS", block)
    want = Counter()
    for s, rows in series(messy.select("symbol", "Date", "Open")).items():
        want.update((s, r[0], r[1] - rows[i - 1][1] if i else 0.0) for i, r in enumerate(rows))
    assert Counter(tuple(r) for r in ops.stock_variation(messy, "d").collect()) == want


def test_head_and_tail_and_latest_rows_of_messy_series(messy):
    want, latest = Counter(), Counter()
    for s, rows in series(messy).items():
        want.update((s, *r) for r in rows[:7] + rows[-7:])
        last = [r for r in rows if r[0] is not None][-4:]
        latest.update((s, *r, sum(x[1] for x in last) / 4) for r in last)
    assert Counter(tuple(r) for r in ops.head_and_tail(messy, 7).collect()) == want
    assert Counter(tuple(r) for r in ops.latest_average(messy, "Open", 4, digits=None).collect()) == latest


def test_positions_pair_rows_of_one_date_by_their_values(messy):
    rows = {s: sorted(((r[0], r[1], r[4]) for r in v if r[0] is not None), key=key) for s, v in series(messy).items()}
    x, y = [r[1] for r in rows["A"]], [r[2] for r in rows["B"]]
    k = min(len(x), len(y))
    mx, my = sum(x[:k]) / k, sum(y[:k]) / k
    cov = sum((a - mx) * (b - my) for a, b in zip(x, y))
    corr = cov / (sum((a - mx) ** 2 for a in x[:k]) * sum((b - my) ** 2 for b in y[:k])) ** 0.5
    got = ops.correlation_between(messy, [("A", "B")], "Open", "Close").first().correlation
    assert got == pytest.approx(corr)


@pytest.mark.parametrize("name", ["moving_average_5", "stock_variation_d", "correlation_pair", "correlation_matrix", "head_tail_3", "latest_average", "anchored_avg_return_w", "anchored_monthly_variation"])
def test_results_do_not_depend_on_the_order_of_rows(spark, name):
    bars = with_gaps(load_bars(spark, SF)).cache()
    results = []
    for order in (F.col("Date").desc(), F.xxhash64("Date", "Open", "Volume")):
        shuffled = spark.createDataFrame(bars.orderBy(order).collect(), bars.schema).repartition(3)
        query = spark_queries(load=lambda *_, b=shuffled: b)
        plain = name if name in query and name != "head_tail_3" else None
        df = query[plain](spark, SF) if plain else ops.head_and_tail(shuffled, 3)
        results.append(Counter(repr(tuple(r)) for r in df.collect()))
    assert results[0] == results[1]


def windows_of(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if "Window [" in line or "Window (" in line]


def test_no_window_over_the_rows_of_a_whole_symbol(spark, messy):
    for df in (ops.moving_average(messy, "Open", 5), ops.stock_variation(messy, "d")):
        found = [w for w in windows_of(df)]
        assert found
        for w in found:
            # by symbol and block, by symbol and year, or over one counted row per year
            assert "_block" in w or "row_number" in w and "_range" in w or "sum(_n" in w, w


def test_ends_leave_the_map_side_by_a_group_limit(spark):
    df = ops.head_and_tail(load_bars(spark, SF), 40)
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.index("Initial Plan"):] if "Initial Plan" in plan else plan
    assert plan.count("WindowGroupLimit") == 2 and plan.count("FileScan") == 2  # before and after the shuffle; orders and lineitem once
