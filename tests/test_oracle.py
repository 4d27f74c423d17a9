"""Every registered query equals its DuckDB oracle on the driver tables, and
the driver contract holds (entry smoke check, keys, column names)."""

import os

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck
from tallyhawk.plans import catalog

SF_DIR = os.environ.get("TH_ORACLE_SF_DIR", "/root/testdata/sf0.001")

#: The library's own queries; the optional ones, some of which SQL can't
#: express, have their tests beside them.
KEYS = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["event_dt", "passport", "fio", "phone", "event_type", "report_dt"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(catalog.ORACLE) == set(catalog.QUERIES)
    assert set(KEYS) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    res = compare(spark, con, SF_DIR, key, E.queries()[key], E.oracle_sql()[key])
    assert res["ok"], res


def test_results_convert_to_pandas(spark):
    """Result consumers often go through pandas (nanosecond timestamps):
    no registered query may emit a value outside that range."""
    for key in KEYS:
        df = E.queries()[key](spark, SF_DIR)
        assert list(df.toPandas().columns) == df.columns


def test_queries_do_not_depend_on_the_session_time_zone(spark, con):
    """Registered queries keep the caller's settings and give the same
    results in any session time zone (all timestamps are wall-clock)."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        for key in ["rule3_city_hop", "rule4_amount_probe", "scd2_incremental_merge", "discover_file_dates", "fraud_report_daily"]:
            res = compare(spark, con, SF_DIR, key, E.queries()[key], E.oracle_sql()[key])
            assert res["ok"], res
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Kolkata"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
