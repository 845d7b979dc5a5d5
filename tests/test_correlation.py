import pytest

from candela import operators as ops
from tests.conftest import make_bars


def test_column_correlation_golden(sample):
    assert ops.column_correlation(sample, "Open", "Close").first().correlation == pytest.approx(0.672683, abs=1e-6)


def test_nulls_count_as_zero_or_are_dropped(spark):
    rows = [("S", f"2020-01-0{i}", o, c) for i, (o, c) in enumerate([(1.0, 2.0), (2.0, 4.1), (3.0, 5.9), (None, 9.0)], 1)]
    bars = make_bars(spark, rows)
    zero = ops.column_correlation(bars, "Open", "Close").first().correlation
    drop = ops.column_correlation(bars, "Open", "Close", nulls="drop").first().correlation
    import numpy as np

    assert zero == pytest.approx(np.corrcoef([1, 2, 3, 0], [2, 4.1, 5.9, 9])[0, 1])
    assert drop == pytest.approx(np.corrcoef([1, 2, 3], [2, 4.1, 5.9])[0, 1])


def test_pair_correlation_by_position_cuts_to_shorter(spark):
    a = [("A", f"2020-01-{d:02d}", float(d), 0.0) for d in range(1, 6)]
    b = [("B", f"2020-02-{d:02d}", 1.0, float(d * d)) for d in range(1, 9)]
    bars = make_bars(spark, a + b)
    r = ops.correlation_between(bars, [("A", "B"), ("B", "A")], "Open", "Close").collect()
    got = {(x.symbol_1, x.symbol_2): x.correlation for x in r}
    import numpy as np

    assert got[("A", "B")] == pytest.approx(np.corrcoef([1, 2, 3, 4, 5], [1, 4, 9, 16, 25])[0, 1])
    by_date = ops.correlation_between(bars, [("A", "B")], on="date").collect()
    assert by_date == []  # no common dates


def test_correlation_matrix_full_join(spark):
    a = [("A", f"2020-01-{d:02d}", float(d), 0.0) for d in range(1, 6)]
    b = [("B", f"2020-02-{d:02d}", float(d % 3), 0.0) for d in range(1, 9)]
    rows = {r.variable: r for r in ops.correlation_matrix(make_bars(spark, a + b), "A", "B", "Open").collect()}
    import numpy as np

    assert rows["D1"].D1 == pytest.approx(1.0)
    assert rows["D2"].D2 == pytest.approx(1.0)
    assert rows["D1"].D2 == pytest.approx(np.corrcoef([1, 2, 3, 4, 5], [1, 2, 0, 1, 2])[0, 1])
    assert rows["D2"].D1 == rows["D1"].D2


def test_pair_list_must_not_be_empty(sample):
    with pytest.raises(ValueError):
        ops.correlation_between(sample, [])
