from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from candela.schema import BARS_SCHEMA  # noqa: E402

# An invented price file (header + 17 rows), written to a temporary CSV by the fixtures below: six years, irregular
# gaps, four rows in one week, two offsets, prices outside their day's range in the last rows.
SAMPLE_CSV = """Date,Open,High,Low,Close,Volume,Dividends,Stock Splits
2018-07-09 00:00:00-04:00,41.2512,41.5844,40.7512,41.3344,21500731,520.0,0.0
2018-10-14 00:00:00-04:00,41.9035,42.8617,41.4035,42.6117,18204466,88.0,0.0
2018-10-15 00:00:00-04:00,41.9035,58.5009,41.4035,58.2509,18204466,88.0,0.0
2019-02-11 00:00:00-05:00,40.7764,41.0264,39.6126,40.1126,16980022,431.5,0.0
2019-03-18 00:00:00-05:00,42.0181,72.2442,41.5181,71.9942,20733915,520.0,0.0
2019-07-22 00:00:00-05:00,43.6627,43.9127,43.1627,43.6627,17650308,88.0,0.0
2020-08-23 00:00:00-05:00,44.1193,44.3693,43.5251,44.0251,23917644,0.287,0.0
2020-11-02 00:00:00-05:00,45.0048,45.5819,44.5048,45.3319,27400189,300.0,0.0
2020-12-27 00:00:00-05:00,44.8306,45.1673,44.3306,44.9173,11875320,88.0,0.0
2021-01-24 00:00:00-05:00,46.2719,46.5219,45.5055,46.0055,14290077,210.0,0.0
2021-04-07 00:00:00-05:00,47.5502,47.8002,46.6218,47.1218,26006123,431.5,0.0
2022-02-08 00:00:00-05:00,46.9914,47.2414,46.0023,46.5023,24811940,431.5,0.0
2022-05-16 00:00:00-05:00,48.3375,49.2291,47.8375,48.9791,41250037,64.0,0.0
2023-06-13 00:00:00-05:00,50.1208,51.1336,49.6208,50.8836,19046618,115.0,0.0
2023-06-14 00:00:00-05:00,55.6642,51.75,49.5,70.2215,19046618,115.0,0.0
2023-06-15 00:00:00-05:00,61.0917,51.75,49.5,88.4402,19046618,115.0,0.0
2023-06-16 00:00:00-05:00,52.4436,51.75,49.5,50.0059,19046618,115.0,0.0
"""


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="candela-tests-")


@pytest.fixture(scope="session")
def spark(scratch):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("candela-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from candela.session import checkpoint_dir

    checkpoint_dir(session, fallback=os.environ.get("CHECKPOINT_DIR") or os.path.join(scratch, "checkpoints"))
    yield session


@pytest.fixture(scope="session")
def sample_csv(scratch):
    folder = os.path.join(scratch, "prices")
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, "test.csv")
    with open(path, "w") as f:
        f.write(SAMPLE_CSV)
    return path


@pytest.fixture(scope="session")
def sample(spark, sample_csv):
    from candela.sources import read_bars_csv

    return read_bars_csv(spark, sample_csv).cache()


def make_bars(spark, rows):
    """rows: (symbol, 'YYYY-MM-DD' | None, open, close[, volume]) -> bars DataFrame."""
    out = []
    for r in rows:
        sym, day, o, c = r[:4]
        vol = r[4] if len(r) > 4 else 1000
        date = dt.date.fromisoformat(day) if day else None
        out.append((sym, date, o, None if o is None or c is None else max(o, c), None if o is None or c is None else min(o, c), c, vol, 0.5, 0.0))
    return spark.createDataFrame(out, BARS_SCHEMA)


def by_symbol(df, key="symbol"):
    res = {}
    for r in df.collect():
        res.setdefault(r[key], []).append(r.asDict())
    return res
