"""Property tests: random fleets against the plain-Python loop model."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fleetlens.plans.model import UsageModel
from fleetlens.sources.scan import CANONICAL_SCHEMA
from loop_model import fleet

ALPHA = "abAB-0é字"
name_st = st.one_of(st.none(), st.text(alphabet=ALPHA, min_size=0, max_size=8))
row_st = st.tuples(
    name_st,
    st.sampled_from(["_Total", "0", "x_Totalx", None]),
    st.one_of(st.none(), st.datetimes(min_value=dt.datetime(2021, 8, 1), max_value=dt.datetime(2021, 8, 31, 23))),
    st.one_of(st.none(), st.integers(min_value=0, max_value=1000).map(float)),
)
SETTINGS = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row_st, min_size=0, max_size=20))
def test_model_equals_loops(spark, data):
    df = spark.createDataFrame(data, CANONICAL_SCHEMA)
    m = UsageModel(df)
    expect = fleet(data)
    got = {}
    for part in ("hour", "weekday", "monthday"):
        for r in m.profile(part).collect():
            got[(r.client, r.host, part, r[part])] = (r.total, r.value)
    assert got == expect["host_profile"]
    assert {(r.client, r.host): r.total for r in m.host_totals().collect()} == expect["host_total"]
    assert {r.client: r.total for r in m.client_totals().collect()} == expect["client_total"]
    cp = {(r.client, r.hour): (r.total, r.value) for r in m.profile("hour", level="client").collect()}
    assert cp == expect["client_profile"]


@SETTINGS
@given(st.lists(row_st, min_size=1, max_size=25))
def test_host_shares_sum_to_100(spark, data):
    m = UsageModel(spark.createDataFrame(data, CANONICAL_SCHEMA))
    sums = {}
    for r in m.host_share().collect():
        if r.pct is not None:
            sums[r.client] = sums.get(r.client, 0.0) + r.pct
    assert all(abs(v - 100.0) < 1e-9 for v in sums.values())


@SETTINGS
@given(
    st.lists(
        st.tuples(st.sampled_from(["aaa", "bbb"]), st.sampled_from("CDE"), st.integers(0, 23), st.integers(0, 50)),
        min_size=1,
        max_size=20,
    )
)
def test_positional_equals_contains_without_overlap(spark, data):
    # names "aaa-C1": client and host letters never occur elsewhere in the name
    rows = [(f"{c}-{h}1", "_Total", dt.datetime(2021, 8, 2, hr), float(v)) for c, h, hr, v in data]
    df = spark.createDataFrame(rows, CANONICAL_SCHEMA)
    a = UsageModel(df).client_report()
    b = UsageModel(df, membership="positional").client_report()
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_partitioning_does_not_change_results(spark):
    from fleetlens.sources.scan import events_samples

    s = events_samples(spark, "/root/testdata/sf0.001")
    a = UsageModel(s).fleet_report()
    b = UsageModel(s.repartition(7)).fleet_report()
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, a.collect()), key=key) == sorted(map(tuple, b.collect()), key=key)


def test_salted_split_spreads_a_hot_server(spark):
    """One server with most of the rows: the salted join spreads it over many
    partitions and still returns every row once per group."""
    import datetime as dt

    from pyspark.sql import functions as F

    from fleetlens.operators.membership import attach

    hot = [("aig-A0", "_Total", dt.datetime(2021, 8, 1, i % 24, i % 60), float(i)) for i in range(2000)]
    cold = [("eti-B0", "_Total", dt.datetime(2021, 8, 1, 1), 1.0)]
    rows_df = spark.createDataFrame(hot + cold, CANONICAL_SCHEMA)
    members = spark.createDataFrame([("aig-A0", "aig", "A"), ("eti-B0", "eti", "B")], "server_name string, client string, host string")
    out = attach(rows_df, members, broadcast=False, salts=16)
    assert out.count() == 2001
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "false")  # keep the shuffle's partitions visible
        per_part = out.where(F.col("server_name") == "aig-A0").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set(key, old)
    assert len(per_part) >= 4 and max(r["count"] for r in per_part) < 2000 * 0.6


@SETTINGS
@given(
    st.lists(
        st.tuples(
            st.text(alphabet="abAB-0", min_size=5, max_size=8),
            st.integers(0, 23),
            st.integers(0, 100),
        ),
        min_size=1,
        max_size=20,
    )
)
def test_host_sum_at_least_client_total(spark, data):
    # every name has a fifth character (a host key) and metrics are >= 0:
    # overlap can only add, so the host totals of a client cover its total
    rows = [(n, "_Total", dt.datetime(2021, 8, 2, h), float(v)) for n, h, v in data]
    m = UsageModel(spark.createDataFrame(rows, CANONICAL_SCHEMA))
    host_sum = {}
    for r in m.host_totals().collect():
        host_sum[r.client] = host_sum.get(r.client, 0.0) + r.total
    for r in m.client_totals().collect():
        if r.total is not None:
            assert host_sum.get(r.client, 0.0) >= r.total - 1e-9


def test_only_hot_servers_are_salted(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    hot = [("aig-A0", "_Total", dt.datetime(2021, 8, 1 + i % 28, i % 24, i % 60), float(i)) for i in range(3000)]
    cold = [(f"aig-B{i}", "_Total", dt.datetime(2021, 8, 2, i % 24), 1.0) for i in range(40)]
    df = spark.createDataFrame(hot + cold, CANONICAL_SCHEMA)
    forced = UsageModel(df, max_broadcast_bytes=0)
    hot_list = forced.hot_servers.collect()
    assert [r.server_name for r in hot_list] == ["aig-A0"]
    # 3000 of 3040 rows; threshold = ceil(3040 / 8 partitions) = 380 -> 8 salts (capped at 8)
    assert hot_list[0]["_salts"] == 8
    key = lambda r: tuple((x is None, str(x)) for x in r)
    got = forced.host_rows()
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, UsageModel(df).host_rows().collect()), key=key)
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(conf)
    try:
        spark.conf.set(conf, "false")
        spread = got.where(F.col("server_name") == "aig-A0").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set(conf, old)
    # aig-A0 belongs to host A only: its 3000 rows are spread, not in one task
    assert len(spread) >= 4 and max(r["count"] for r in spread) < 0.6 * 3000
