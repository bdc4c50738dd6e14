"""Every registered query equals its SQL twin (DuckDB) on the small tables."""
import re

import pytest

import __spark_entry__ as E
from tools.oracle import compare, duckdb_connection

from conftest import SF_SMALL

SQL = E.oracle_sql()
KEYS = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


# queries that SQL cannot express are tested in tests/llm
LLM = {k for k in KEYS if k == "pipeline" or re.match(r"op\d+_", k)}
KEYS = [k for k in KEYS if k not in LLM]


def test_every_query_has_sql_twin():
    assert set(SQL) - LLM == set(KEYS)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, SF_SMALL, key, E.queries()[key], SQL[key], con)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["zone", "revenue"]
    assert df.count() > 0


@pytest.mark.parametrize("key", ["trip_duration", "epoch_millis_roundtrip", "longest_trip", "session_by_key",
                                 "stream_tumble_1h_by_key", "stream_session_global_by_key"])
def test_time_queries_do_not_depend_on_session_time_zone(spark, con, key):
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = compare(spark, SF_SMALL, key, E.queries()[key], SQL[key], con)
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert r["ok"], r
