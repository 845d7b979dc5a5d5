import datetime as dt
import os

import duckdb
import pytest
from pyspark.sql import types as T

from candela.plans.catalog import BARS_CTE
from candela.schema import BARS_SCHEMA
from candela.session import materialize
from candela.sources import load_bars, read_bars_csv, write_bars

SF = "/root/testdata/sf0.001"


def test_csv_scan_golden(sample):
    assert [(f.name, f.dataType) for f in sample.schema] == [(f.name, f.dataType) for f in BARS_SCHEMA]
    rows = sample.orderBy("Date").collect()
    assert len(rows) == 17
    assert {r.symbol for r in rows} == {"test"}
    assert rows[0].Date == dt.date(2018, 7, 9) and rows[-1].Date == dt.date(2023, 6, 16)
    # the -05:00 offset does not move the day
    assert rows[3].Date == dt.date(2019, 2, 11)
    # volume is exact (a float32 read would give 41250036)
    assert rows[12].Volume == 41250037
    assert rows[0].Open == pytest.approx(41.2512, abs=1e-12)


def test_multi_file_scan_names_symbols(spark, scratch):
    folder = os.path.join(scratch, "multi")
    os.makedirs(folder, exist_ok=True)
    header = "Date,Open,High,Low,Close,Volume,Dividends,Stock Splits\n"
    with open(os.path.join(folder, "AAA.csv"), "w") as f:
        f.write(header + "2020-01-02 00:00:00-05:00,1.0,2.0,0.5,1.5,100,0.0,0.0\n")
    with open(os.path.join(folder, "BBB.csv"), "w") as f:
        f.write(header + "2020-01-02,3.0,4.0,2.5,3.5,200.0,0.0,0.0\nnot a date,1,1,1,1,1,0,0\n")
    bars = read_bars_csv(spark, os.path.join(folder, "*.csv"))
    rows = sorted(bars.collect(), key=lambda r: (r.symbol, str(r.Date)))
    assert [(r.symbol, r.Date, r.Volume) for r in rows] == [
        ("AAA", dt.date(2020, 1, 2), 100),
        ("BBB", dt.date(2020, 1, 2), 200),
        ("BBB", None, 1),
    ]


def test_bars_adapter_matches_sql(spark):
    bars = load_bars(spark, SF)
    got = sorted(tuple(r) for r in bars.collect())
    con = duckdb.connect()
    for t in ("orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = sorted(con.execute(f"WITH {BARS_CTE} SELECT * FROM bars").fetchall())
    assert got == want
    assert bars.select("symbol", "Date").distinct().count() == len(got)


def test_write_and_materialize_roundtrip(spark, sample, scratch):
    path = os.path.join(scratch, "bars_parquet")
    write_bars(sample, path)
    back = spark.read.parquet(path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, sample.collect()))
    cut = materialize(sample, "sample")
    assert cut.count() == 17
    assert isinstance(cut.schema["Volume"].dataType, T.LongType)


def test_csv_nulls_nan_and_bad_dates(spark, scratch):
    from candela import operators as ops

    folder = os.path.join(scratch, "dirty")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "DIRTY.csv"), "w") as f:
        f.write(
            "Date,Open,High,Low,Close,Volume,Dividends,Stock Splits\n"
            "2020-01-01,,2,1,1.5,100,0,0\n"
            "2020-01-02,1,2,1,NaN,100,0,0\n"
            "2020-01-03,1,2,1,1.5,,0,0\n"
            "garbage,1,2,1,1.5,100,0,0\n"
        )
    bars = read_bars_csv(spark, os.path.join(folder, "DIRTY.csv"))
    miss = ops.missing_counts(bars).first()
    assert (miss.missing_Date, miss.missing_Open, miss.missing_Close, miss.missing_Volume) == (1, 1, 1, 1)
    assert ops.num_observations(bars).first().num_observations == 4
    # null / NaN returns become 0; the row whose date did not parse stays
    daily = {r.Date: r.Daily_Return for r in ops.period_return(bars, "d").collect()}
    assert daily == {dt.date(2020, 1, 1): 0.0, dt.date(2020, 1, 2): 0.0, dt.date(2020, 1, 3): 50.0, None: 50.0}
    assert ops.stock_variation(bars, "d").count() == 4


def test_names_and_volumes_of_price_files(spark, scratch):
    import gzip

    folder = os.path.join(scratch, "names")
    os.makedirs(folder, exist_ok=True)
    text = "Date,Open,High,Low,Close,Volume,Dividends,Stock Splits\n" + "".join(
        f"2020-01-0{i},1,2,1,1.5,{v},0,0\n" for i, v in enumerate(["12.9", "13.0", "9007199254740993", "many"], 1)
    )
    with open(os.path.join(folder, "BRK B+C.csv"), "w") as f:
        f.write(text)
    with gzip.open(os.path.join(folder, "ZIP.csv.gz"), "wt") as f:
        f.write(text)
    rows = read_bars_csv(spark, folder).orderBy("symbol", "Date").collect()
    assert [r.symbol for r in rows] == ["BRK B+C"] * 4 + ["ZIP"] * 4
    assert [r.Volume for r in rows[:4]] == [None, 13, 9007199254740993, None]
    with open(os.path.join(folder, "prices.txt"), "w") as f:
        f.write(text)
    with pytest.raises(Exception, match="no symbol in the file name"):
        read_bars_csv(spark, os.path.join(folder, "prices.txt")).collect()


def test_bars_of_a_range_are_the_bars_in_the_range(spark):
    whole = load_bars(spark, SF).where("Date between '1996-01-01' and '1998-12-31'")
    part = load_bars(spark, SF, "1996-01-01", "1998-12-31")
    assert sorted(map(tuple, part.collect())) == sorted(map(tuple, whole.collect()))


def price_file(folder, name, text, mtime=None):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    if mtime is not None:
        os.utime(path, (mtime, mtime))
    return path


HEADER = "Date,Open,High,Low,Close,Volume,Dividends,Stock Splits\n"


def test_columns_are_found_by_name(spark, scratch):
    folder = os.path.join(scratch, "reordered")
    price_file(folder, "A.csv", HEADER + "2020-01-02,1,4,0.5,2,100,0.25,3\n")
    price_file(folder, "B [1].csv", "Date,Close,High,Low,Open,Volume,Adj,Stock Splits,Dividends\n2020-01-02,2,4,0.5,1,100,9,3,0.25\n")
    price_file(folder, "C.csv", '﻿"Volume","Date", Open ,High,Low,Close,Dividends,Stock Splits\n100,2020-01-02,1,4,0.5,2,0.25,3\n')
    rows = read_bars_csv(spark, folder).orderBy("symbol").collect()
    assert [r.symbol for r in rows] == ["A", "B [1]", "C"]
    assert {tuple(r)[1:] for r in rows} == {(dt.date(2020, 1, 2), 1.0, 4.0, 0.5, 2.0, 100, 0.25, 3.0)}


def test_files_without_a_column_or_header_fail(spark, scratch):
    path = price_file(os.path.join(scratch, "lacking"), "A.csv", "Date,Open,High,Low,Close,Volume\n2020-01-02,1,4,0.5,2,100\n")
    with pytest.raises(ValueError, match="no column Dividends, Stock Splits"):
        read_bars_csv(spark, path)
    path = price_file(os.path.join(scratch, "headless"), "A.csv", "2020-01-02,1,4,0.5,2,100,0,0\n")
    with pytest.raises(ValueError, match="no header line"):
        read_bars_csv(spark, path)
    assert read_bars_csv(spark, price_file(os.path.join(scratch, "blank"), "A.csv", "")).collect() == []
    assert read_bars_csv(spark, price_file(os.path.join(scratch, "bare"), "A.csv", HEADER)).collect() == []


def test_refused_lines_are_counted_listed_and_left_out(spark, scratch):
    lines = [
        "2020-01-01,1,2,1,1.5,100,0,0",
        "2020-01-02,1,2",  # short
        "2020-01-03,1,2,1,1.5,100,0,0,7,8",  # long
        "2020-01-04,one,2,1,1.5,100,0,0",
        "someday,1,2,1,1.5,100,0,0",
        "2020-01-06,1,2,1,1.5,12.5,0,0",
        "2020-01-07,,2,1,NaN,,0,0",  # holes are no faults
        "",
    ]
    path = price_file(os.path.join(scratch, "refused"), "A.csv", HEADER + "\n".join(lines) + "\n")
    from candela.sources import line_counts, refused_lines

    assert [tuple(r) for r in line_counts(spark, path).collect()] == [("A", 2, 5)]
    found = refused_lines(spark, path)
    assert found.columns == ["symbol", "file", "line"]
    listed = {r.line for r in found.collect()}
    assert set(lines[1:4]) <= listed and len(listed) == 5 and any(x.startswith("someday,") for x in listed)
    kept, dropped = read_bars_csv(spark, path), read_bars_csv(spark, path, refused="drop")
    assert kept.count() == 7 and sorted(r.Date.day for r in dropped.collect()) == [1, 7]
    assert kept.select("symbol").count() == 7 and kept.where("Date is null").count() == 1  # whatever columns are read
    with pytest.raises(ValueError):
        read_bars_csv(spark, path, refused="maybe")


def test_the_file_written_last_has_the_day(spark, scratch):
    base = os.path.join(scratch, "exports")
    row = "2020-01-0{},{},9,1,1.5,100,0,0\n"
    price_file(f"{base}/one", "A.csv", HEADER + row.format(1, 11) + row.format(2, 12) + "?,5,9,1,1,1,0,0\n", 2_000)
    price_file(f"{base}/two", "A.csv", HEADER + row.format(2, 22) + row.format(3, 23) + row.format(3, 24) + "?,5,9,1,1,1,0,0\n", 1_000)
    price_file(f"{base}/two", "B.csv", HEADER + row.format(2, 32), 9_000)
    price_file(f"{base}/zwei", "B.csv", HEADER + row.format(2, 33), 9_000)
    paths = [f"{base}/one", f"{base}/two", f"{base}/zwei"]
    bars = read_bars_csv(spark, paths)
    dated = {(r.symbol, r.Date.day): r.Open for r in bars.where("Date is not null").collect()}
    assert dated == {("A", 1): 11.0, ("A", 2): 12.0, ("A", 3): 24.0, ("B", 2): 33.0}  # later time, else later name, else larger values
    assert bars.count() == 4 + 2  # rows without a date stay
    assert read_bars_csv(spark, paths, overlap="all").count() == 9
    plan = bars._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_price_files_round_trip(spark, sample, scratch):
    from candela.sources import write_bars_csv

    both = sample.unionByName(sample.selectExpr("'BRK B/é' as symbol", *[f"`{c}`" for c in sample.columns[1:]]))
    folder = os.path.join(scratch, "written-csv")
    write_bars_csv(both.where("symbol = 'test'"), folder, reversed(sample.columns[1:]))
    assert sorted(f for f in os.listdir(folder) if f.endswith(".csv")) == ["test.csv"]
    assert sorted(map(tuple, read_bars_csv(spark, folder).collect())) == sorted(map(tuple, sample.collect()))


def test_a_range_reads_only_the_folders_of_its_years(spark, sample, scratch):
    from candela import operators as ops
    from candela.sources import read_bars

    path = os.path.join(scratch, "bars-by-year")
    write_bars(sample.unionByName(sample.limit(1).selectExpr("symbol", "cast(null as date) as Date", *[f"`{c}`" for c in sample.columns[2:]])), path, by_year=True)
    assert sorted(map(tuple, read_bars(spark, path).where("Date is not null").collect())) == sorted(map(tuple, sample.collect()))
    assert read_bars(spark, path).count() == 18
    part = read_bars(spark, path, "2019-03-01", "2020-09-30")
    want = sample.where("Date between '2019-03-01' and '2020-09-30'")
    assert sorted(map(tuple, part.collect())) == sorted(map(tuple, want.collect()))
    plan = ops.return_rate(part, "2019-03-01", "2020-09-30", 200)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bar_year" in plan and "(bar_year" in plan and ">= 2019" in plan and "<= 2020" in plan


def test_average_of_a_symbol_with_nothing_in_range(spark):
    from candela import operators as ops
    from tests.conftest import make_bars

    bars = make_bars(spark, [("A", "2020-01-01", 1.0, 1.0), ("A", "2020-01-03", 5.0, 1.0), ("B", "2021-01-01", 3.0, 1.0)])
    args = ("2020-01-01", "2020-12-31", "Open")
    assert [tuple(r) for r in ops.avg_price_until(bars, *args).collect()] == [("A", 3.0)]
    assert {tuple(r) for r in ops.avg_price_until(bars, *args, every_symbol=True).collect()} == {("A", 3.0), ("B", None)}
