"""Hand-computed answers on the ten-row edge fixture (FIXTURES.md section 2)."""

import pytest
from conftest import rows

from fleetlens.operators import keys


def approx(x):
    return pytest.approx(x, rel=1e-12)


def test_client_keys(edge_model):
    assert rows(edge_model.clients) == [("aig",), ("eti",), ("tuv",), ("zor",)]


def test_host_keys(edge_model):
    assert rows(keys.distinct_hosts(edge_model.client_members)) == [("aig", "A"), ("aig", "B"), ("eti", "C")]


def test_overlapping_membership(edge_model):
    # aig-BA belongs to host B (its fifth character) and to host A (contains 'A').
    assert rows(edge_model.host_members) == [
        ("aig-A0", "aig", "A"),
        ("aig-BA", "aig", "A"),
        ("aig-BA", "aig", "B"),
        ("eti-C0", "eti", "C"),
    ]


def test_client_totals(edge_model):
    assert rows(edge_model.client_totals()) == [("aig", 45.0), ("eti", 11.0), ("tuv", 2.0), ("zor", None)]


def test_client_share(edge_model):
    got = {r.client: (r.pct, r.pct_1dp) for r in edge_model.client_share().collect()}
    assert got["aig"][0] == approx(100 * 45 / 58) and got["aig"][1] == 77.6
    assert got["eti"][1] == 19.0 and got["tuv"][1] == 3.4
    assert got["zor"] == (None, None)


def test_host_totals_and_share(edge_model):
    assert rows(edge_model.host_totals()) == [("aig", "A", 45.0), ("aig", "B", 5.0), ("eti", "C", 11.0)]
    got = {(r.client, r.host): r.pct for r in edge_model.host_share().collect()}
    # denominator is the sum of host totals (50), not the client total (45)
    assert got == {("aig", "A"): approx(90.0), ("aig", "B"): approx(10.0), ("eti", "C"): approx(100.0)}


def test_hourly_profile(edge_model):
    got = {(r.client, r.host, r.hour): r.value for r in edge_model.profile("hour").collect()}
    assert got == {
        ("aig", "A", 0): approx(40 / 31),
        ("aig", "A", 1): approx(5 / 31),
        ("aig", "B", 1): approx(5 / 31),
        ("eti", "C", 1): approx(7 / 31),
        ("eti", "C", 5): None,
    }


def test_weekly_profile(edge_model):
    got = {(r.client, r.host, r.weekday): r.value for r in edge_model.profile("weekday").collect()}
    assert got == {
        ("aig", "A", 1): approx(15 / 96),
        ("aig", "A", 2): approx(30 / 96),
        ("aig", "B", 1): approx(5 / 96),
        ("eti", "C", 1): approx(7 / 96),
        ("eti", "C", 3): None,
    }


def test_monthly_profile(edge_model):
    got = {(r.client, r.host, r.monthday): r.value for r in edge_model.profile("monthday").collect()}
    assert got == {
        ("aig", "A", 1): approx(15 / 24),
        ("aig", "A", 2): approx(30 / 24),
        ("aig", "B", 1): approx(5 / 24),
        ("eti", "C", 1): approx(7 / 24),
        ("eti", "C", 3): None,
    }


def test_client_level_hourly(edge_model):
    got = {(r.client, r.hour): r.total for r in edge_model.profile("hour", level="client").collect()}
    assert got == {("aig", 0): 40.0, ("aig", 1): 5.0, ("eti", 1): 7.0, ("eti", 5): None, ("tuv", 3): 2.0}


def test_usage_averages(edge_model):
    got = {(r.client, r.host): (r.month_avg, r.week_avg) for r in edge_model.usage_averages().collect()}
    assert got[("aig", "A")] == (approx(45 / 744), approx(45 / 672))


def test_fleet_report_shape(edge_model):
    from fleetlens.plans.model import REPORT_COLUMNS

    rep = edge_model.fleet_report()
    assert tuple(rep.columns) == REPORT_COLUMNS == ("client", "host", "profile", "bucket", "total", "value", "value_1dp")
    assert tuple(edge_model.client_report().columns) == REPORT_COLUMNS
    counts = {}
    for r in rep.collect():
        counts[r.profile] = counts.get(r.profile, 0) + 1
    assert counts == {"hour": 5, "weekday": 5, "monthday": 5, "share": 3, "month_avg": 3, "week_avg": 3, "client_share": 4}
    labels = {(r.client, r.host): r.value_1dp for r in rep.where("profile in ('share', 'client_share')").collect()}
    assert labels[("aig", "A")] == 90.0 and labels[("aig", None)] == 77.6 and labels[("zor", None)] is None
    averages = {(r.profile, r.host): r.value for r in rep.where("client = 'aig' and profile like '%avg'").collect()}
    assert averages == {("month_avg", "A"): approx(45 / 744), ("week_avg", "A"): approx(45 / 672), ("month_avg", "B"): approx(5 / 744), ("week_avg", "B"): approx(5 / 672)}


def test_key_lists_are_sorted(spark, edge, edge_model):
    assert [tuple(r) for r in keys.distinct_hosts(edge_model.client_members).collect()] == [("aig", "A"), ("aig", "B"), ("eti", "C")]
    shuffled = edge.repartition(4, "avg_processor_time")
    for part, want in (("hour", [0, 1, 2, 3, 5]), ("weekday", [1, 2, 3]), ("monthday", [1, 2, 3])):
        assert [r[0] for r in keys.distinct_dateparts(shuffled, part).collect()] == want


def test_client_charts_in_one_action(spark, edge_model):
    from fleetlens.plans.charts import client_charts

    got = client_charts(edge_model.fleet_report(), "aig")
    assert list(got["hosts"]) == ["A", "B"]
    a = got["hosts"]["A"]
    assert a["hour"] == {"x": [0.0, 1.0], "y": [approx(40 / 31), approx(5 / 31)]}
    assert a["weekday"]["labels"] == ["Sun", "Mon"] and a["month_avg"] == approx(45 / 744) and a["week_avg"] == approx(45 / 672)
    assert got["pie"] == {"labels": ["A", "B"], "sizes": [45.0, 5.0], "pct": [approx(90.0), approx(10.0)], "pct_1dp": [90.0, 10.0]}
    assert client_charts(edge_model.fleet_report(), "none") == {"hosts": {}, "pie": {"labels": [], "sizes": [], "pct": [], "pct_1dp": []}}


def test_positional_mode(edge):
    from fleetlens.plans.model import UsageModel

    m = UsageModel(edge, membership="positional")
    # disjoint groups: aig-BA counts only for host B
    assert rows(m.host_totals()) == [("aig", "A", 40.0), ("aig", "B", 5.0), ("eti", "C", 11.0)]


def test_zero_denominator_share_is_null(spark):
    import datetime as dt

    from fleetlens.plans.model import UsageModel
    from fleetlens.sources.scan import CANONICAL_SCHEMA

    data = [("aaa-C1", "_Total", dt.datetime(2021, 8, 2, 1), 0.0), ("aaa-D1", "_Total", dt.datetime(2021, 8, 2, 1), 0.0)]
    m = UsageModel(spark.createDataFrame(data, CANONICAL_SCHEMA))
    assert {r.pct for r in m.host_share().collect()} == {None}
    assert {r.pct for r in m.client_share().collect()} == {None}


def test_reuse_members_same_results_and_released(spark, edge, edge_model):
    from fleetlens.plans.model import UsageModel

    with UsageModel(edge, reuse_members=True) as m:
        assert rows(m.fleet_report()) == rows(edge_model.fleet_report())
        assert rows(m.host_rows()) == rows(edge_model.host_rows())
        held = list(m._held)
        assert held and all(df.is_cached for df in held)
    assert not any(df.is_cached for df in held)
