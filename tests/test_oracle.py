"""Every registered query against its DuckDB SQL (brute-force contains joins)
on sf0.001; exact values, order-insensitive."""

import datetime as dt
import decimal
import os

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as E
from fleetlens.plans.oracle import oracle_sql
from fleetlens.plans.registry import QUERIES

TABLES = ["events"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return c


def _norm(v):
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, decimal.Decimal):
        return format(v, "f")
    return v


def _key(r):
    return tuple((x is None, str(x)) for x in r)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=_key)
    rel = con.sql(oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    exp = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=_key)
    assert got == exp


def test_every_query_has_oracle():
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["client", "host", "profile", "bucket", "total", "value", "value_1dp"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle_without_broadcast(spark, con, name):
    """Same check with the session's broadcast threshold at -1: the library
    proves nothing small, writes the membership maps and forces (salted)
    sort-merge joins everywhere."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        sdf = QUERIES[name](spark, SF_SMALL)
        cols = sorted(sdf.columns)
        got = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=_key)
    finally:
        spark.conf.set(key, old)
    rel = con.sql(oracle_sql()[name])
    idx = [rel.columns.index(c) for c in cols]
    assert got == sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=_key)


def test_the_data_tells_variants_apart(spark):
    """Client overlap, null and short names, null times and metrics, and a
    client without ``_Total`` rows are all in the test data."""
    assert QUERIES["client_membership"](spark, SF_SMALL).count() > QUERIES["filter_total"](spark, SF_SMALL).where("server_name is not null").count()
    totals = {r["client"]: r["total"] for r in QUERIES["client_totals"](spark, SF_SMALL).collect()}
    assert [c for c, t in totals.items() if t is None] == ["zor"]
    rows = QUERIES["scan_metrics"](spark, SF_SMALL)
    for c in ("server_name", "hr_time", "avg_processor_time"):
        assert rows.where(f"{c} is null").count() > 0
    assert rows.where("length(server_name) < 5").count() > 0
