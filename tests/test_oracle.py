"""Every registered query against its SQL twin on DuckDB (sf0.001): rows, column names, exact values."""

import pytest

import __spark_entry__ as entry
from candela.plans.catalog import spark_queries
from tools.check_oracle import compare, duck_connection

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


def test_every_query_on_bars_has_an_oracle():
    assert set(spark_queries()) <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    ok, n_spark, n_duck, _, _, detail = compare(spark, con, name, QUERIES[name], SQL[name], SF)
    assert ok, detail


def test_entry_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["symbol", "Max_Return_Rate"]
    assert df.count() == 5


SESSION_VARIANT = {
    "spark.sql.ansi.enabled": "false",
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.shuffle.partitions": "3",
    "spark.sql.session.timeZone": "America/Los_Angeles",
}


@pytest.mark.parametrize(
    "name",
    ["max_return_rate_y", "anchored_avg_return_w", "anchored_monthly_variation", "return_rate_period_d",
     "correlation_matrix", "descriptive_stats", "head_tail_40", "month_label"],
)
def test_results_do_not_depend_on_session_settings(spark, con, name):
    saved = {k: spark.conf.get(k) for k in SESSION_VARIANT}
    try:
        for k, v in SESSION_VARIANT.items():
            spark.conf.set(k, v)
        ok, _, _, _, _, detail = compare(spark, con, name, QUERIES[name], SQL[name], SF)
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert ok, detail
