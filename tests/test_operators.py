"""Row-level operators, expressions and the loop equivalence on real data."""

import datetime as dt

from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.operators import aggregates as agg
from fleetlens.operators import filters, keys
from fleetlens.plans.model import UsageModel
from fleetlens.sources.scan import events_samples
from loop_model import fleet


def test_substrings(spark):
    df = spark.createDataFrame([("abcd",), ("ab",), ("",), (None,)], "s string")
    got = {r.s: r.k for r in df.select("s", C.substrings("s", 3).alias("k")).collect()}
    assert got == {"abcd": ["abc", "bcd"], "ab": [], "": [], None: None}


def test_filters(edge):
    assert filters.filter_total(edge).count() == 8
    assert filters.filter_client_total(edge, "aig").count() == 3
    assert filters.filter_client_host(edge, "aig", "B").count() == 1
    assert filters.filter_datepart_eq(edge, "hour", 1).count() == 3  # rows 3, 5, 6
    assert filters.filter_datepart_eq(edge, "weekday", 1).count() == 7


def test_project_and_keys(edge):
    p = filters.project_dateparts(edge).where(F.col("server_name") == "aig-A0").orderBy("hr_time")
    assert [(r.hour, r.weekday, r.monthday) for r in p.collect()] == [(0, 1, 1), (0, 1, 1), (0, 2, 2)]
    d = filters.derive_keys(edge)
    got = {(r.server_name, r.client, r.host) for r in d.collect()}
    assert ("tuv", "tuv", "") in got and (None, None, None) in got and ("aig-BA", "aig", "B") in got


def test_totals(edge):
    assert agg.total_usage(filters.filter_total(edge)).first().total == 59.0
    assert agg.total_usage_projected(filters.filter_total(edge)).first().total == 59.0
    assert agg.total_usage(edge.limit(0)).first().total is None


def test_distinct_dateparts(edge):
    assert rows(keys.distinct_dateparts(edge, "hour")) == [(0,), (1,), (2,), (3,), (5,)]
    assert [r[0] for r in keys.distinct_dateparts(edge, "weekday").collect()] == [1, 2, 3]


def test_row_level_membership(edge_model):
    cr = edge_model.client_rows()
    assert cr.columns[0] == "client"
    assert {(r.client, r.server_name) for r in cr.collect()} == {
        ("aig", "aig-A0"), ("aig", "aig-BA"), ("eti", "eti-C0"), ("tuv", "tuv")
    }
    hr = edge_model.host_rows()
    # aig-A0 x2 (host A), aig-BA x2 (hosts A and B), eti-C0 x3 (host C, incl. null time / null metric)
    assert hr.count() == 7
    # rows with null time / null metric still belong to their groups
    assert hr.where(F.col("hr_time").isNull()).count() == 1


def _same(a, b, within):
    return a is b is None or (a is not None and b is not None and abs(a - b) < within)


def test_matches_loop_model_on_events(spark):
    samples = events_samples(spark, SF_SMALL)
    data = [tuple(r) for r in samples.collect()]
    data = [(n, p, t, float(v) if v is not None else None) for n, p, t, v in data]
    expect = fleet(data)
    m = UsageModel(samples)
    got_prof = {}
    for part in ("hour", "weekday", "monthday"):
        for r in m.profile(part).collect():
            got_prof[(r.client, r.host, part, r[part])] = (r.total, r.value)
    assert set(got_prof) == set(expect["host_profile"])
    for k, (t, v) in expect["host_profile"].items():
        assert _same(got_prof[k][0], t, 1e-6) and _same(got_prof[k][1], v, 1e-9)
    ht = {(r.client, r.host): r.total for r in m.host_totals().collect()}
    assert set(ht) == set(expect["host_total"])
    assert all(_same(ht[k], v, 1e-6) for k, v in expect["host_total"].items())
    ct = {r.client: r.total for r in m.client_totals().collect()}
    assert set(ct) == set(expect["client_total"])
    assert all(_same(ct[k], v, 1e-6) for k, v in expect["client_total"].items()) and None in ct.values()


def test_timestamps_are_zone_free(spark):
    # hr_time is TIMESTAMP_NTZ: date parts do not depend on the session zone
    df = spark.createDataFrame([("a-b-c", "_Total", dt.datetime(2021, 8, 1, 23, 30), 1.0)],
                               "server_name string, processor string, hr_time timestamp_ntz, avg_processor_time double")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert filters.project_dateparts(df).first().hour == 23
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_chart_edge_helpers(edge_model):
    from fleetlens.plans.charts import chart_series, pie_slices, schema_text

    rep = edge_model.client_report()
    s = chart_series(rep, "aig", "A", "hour")
    assert s["x"] == [0, 1] and abs(s["y"][0] - 40 / 31) < 1e-12
    p = pie_slices(rep, "aig")
    assert p["labels"] == ["A", "B"] and p["sizes"] == [45.0, 5.0] and abs(p["pct"][0] - 90.0) < 1e-9
    w = chart_series(rep, "aig", "A", "weekday")
    assert w["x"] == [1, 2] and w["labels"] == ["Sun", "Mon"]  # 2021-08-01 was a Sunday
    text = schema_text(edge_model.samples)
    assert "server_name: string" in text and "hr_time: timestamp_ntz" in text
