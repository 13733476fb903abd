"""Plan shape: no nested-loop or cartesian joins, no Python in the plans,
filters reach the scan, and the raw table is aggregated before any join."""

import pytest
from conftest import SF_SMALL

from fleetlens.plans.registry import QUERIES

BAD_NODES = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "PythonUDF")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loop_or_python(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for node in BAD_NODES:
        assert node not in plan, f"{name}: {node}"


def test_bucket_pass_is_one_aggregation(spark):
    from fleetlens.operators.aggregates import server_buckets
    from fleetlens.sources.scan import events_samples

    plan = _plan(server_buckets(events_samples(spark, SF_SMALL)))
    assert plan.count("Exchange") == 1  # one shuffle, after the partial aggregation
    assert "Generate inline" in plan and "partial_sum" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in plan


def _executed(df):
    """The final plan of a run (adaptive plans show it only afterwards)."""
    df.write.format("noop").mode("overwrite").save()
    frame = df._jdf.queryExecution().executedPlan()
    return frame.toString()


def test_profiles_read_only_reduced_tables(spark):
    plan = _executed(QUERIES["hourly_profile_host"](spark, SF_SMALL))
    assert "events.parquet" not in plan  # raw data was reduced and written before
    scanned = [ln for ln in plan.splitlines() if "Scan parquet" in ln or "FileScan parquet" in ln]
    assert scanned and any("profile" in ln for ln in scanned)
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def _written_plans(spark, run):
    """Physical plans of all Parquet writes that ``run()`` makes."""
    from fleetlens import runtime

    seen = []
    original = runtime.materialize

    def spy(df, label, *args, **kwargs):
        seen.append((label, _plan(df)))
        return original(df, label, *args, **kwargs)

    import fleetlens.plans.model as model

    model.materialize = spy
    try:
        run()
    finally:
        model.materialize = original
    return seen


@pytest.mark.parametrize("name", ["host_totals", "client_totals", "host_share", "client_share", "usage_averages", "distinct_hosts"])
def test_totals_do_not_read_the_time(spark, name):
    plans = _written_plans(spark, lambda: QUERIES[name](spark, SF_SMALL).collect())
    (bucket,) = [p for label, p in plans if label == "buckets"]
    read = bucket.split("ReadSchema: ")[1].split("\n")[0]
    assert "ts:" not in read and "value:double" in read
    assert bucket.count("Exchange") == 1 and "inline" not in bucket


def test_one_profile_expands_only_itself(spark):
    plans = _written_plans(spark, lambda: QUERIES["weekly_profile_host"](spark, SF_SMALL).collect())
    (bucket,) = [p for label, p in plans if label == "buckets"]
    assert "dayofweek" in bucket and "dayofmonth" not in bucket and "hour(" not in bucket


def test_client_totals_join_nothing_but_the_members(spark, edge):
    from fleetlens.plans.model import UsageModel

    plan = _plan(UsageModel(edge).client_totals())
    assert "Union" in plan and "LeftOuter" not in plan


def _above_raw_scan(plan, marker):
    """Operators between the plan's root and the leaf that reads the raw rows."""
    lines = plan.splitlines()
    leaf = next(i for i, ln in enumerate(lines) if marker in ln)
    depth = lambda ln: len(ln) - len(ln.lstrip(" :+-*()0123456789"))
    chain, at = [], depth(lines[leaf])
    for ln in reversed(lines[:leaf]):
        if depth(ln) < at:
            chain.append(ln)
            at = depth(ln)
    return chain


def test_row_splits_do_not_shuffle_raw_rows(spark):
    """200,000 distinct names: the key lists stay kilobytes, and each row is
    matched where it is read."""
    from pyspark.sql import functions as F

    from fleetlens.plans.model import UsageModel
    from fleetlens.runtime import scratch_path
    from fleetlens.sources.scan import CANONICAL_SCHEMA

    path = scratch_path(spark, "many-names")
    n = F.col("id")
    spark.range(200_000).select(
        F.concat(F.element_at(F.array(*[F.lit(c) for c in ("aig", "eti", "tuv")]), (n % 3 + 1).cast("int")), F.lit("-"), F.char(65 + n % 9), F.lpad(n.cast("string"), 12, "0")).alias("server_name"),
        F.lit("_Total").alias("processor"),
        F.lit(None).cast("timestamp_ntz").alias("hr_time"),
        n.cast("double").alias("avg_processor_time"),
    ).write.parquet(path)
    model = UsageModel(spark.read.schema(CANONICAL_SCHEMA).parquet(path))
    for rows, times in ((model.client_rows(), 1), (model.host_rows(), 1)):
        plan = _plan(rows)
        chain = _above_raw_scan(plan, "ReadSchema: struct<server_name:string,processor:string")
        assert chain and not any("Exchange" in ln for ln in chain), plan
        assert "BroadcastHashJoin" in plan and "xxhash64" not in plan
        assert rows.count() == 200_000 * times


def _key(r):
    return tuple((x is None, str(x)) for x in r)


@pytest.mark.parametrize("limit", [0, 1])
def test_over_broadcast_limit_same_results(spark, edge, edge_model, limit):
    from fleetlens.plans.model import UsageModel

    m = UsageModel(edge, max_broadcast_bytes=limit)
    assert not m._hm_fits and not m._cm_fits
    # forced sort-merge joins: no size estimate may turn them into broadcasts
    plan = m.fleet_report()._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert sorted(map(tuple, m.fleet_report().collect()), key=_key) == sorted(
        map(tuple, edge_model.fleet_report().collect()), key=_key
    )
    hr = m.host_rows()
    hr_plan = hr._jdf.queryExecution().executedPlan().toString()
    assert "xxhash64" in hr_plan and "SortMergeJoin" in hr_plan  # key lists over the limit: salted shuffle join
    assert sorted(map(tuple, hr.collect()), key=_key) == sorted(map(tuple, edge_model.host_rows().collect()), key=_key)
    assert sorted(map(tuple, m.client_rows().collect()), key=_key) == sorted(
        map(tuple, edge_model.client_rows().collect()), key=_key
    )


def test_equal_rows_of_a_hot_key_spread(spark):
    from pyspark.sql import functions as F

    from fleetlens.operators.joins import keyed_join

    large = spark.range(4000).select(F.lit("hot").alias("k"), F.lit(1).alias("v"))  # all alike
    small = spark.createDataFrame([("hot", "g")], "k string, g string")
    out = keyed_join(large, small, "k", broadcast=False, salts=8)
    assert out.count() == 4000
    with_sizes = {key: spark.conf.get(key) for key in ("spark.sql.adaptive.enabled",)}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = keyed_join(large, small, "k", broadcast=False, salts=8).groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", with_sizes["spark.sql.adaptive.enabled"])
    assert len(parts) >= 3 and max(r["count"] for r in parts) < 3000


def test_salts_do_not_depend_on_the_order_of_rows(spark):
    """A map task that is run again may read its rows in another order; a row must not change partition."""
    from pyspark.sql import functions as F

    from fleetlens.operators.joins import SALT, salted

    base = [(f"k{i % 3}", i % 50, None if i % 7 == 0 else f"v{i % 11}") for i in range(600)]

    def assigned(rows):
        one = spark.createDataFrame(rows, "k string, n int, v string").coalesce(1)  # one map task
        return sorted(map(tuple, salted(one, F.lit(8)).withColumn("k", F.col("k")).collect()), key=str)

    first = assigned(base)
    assert first == assigned(base[::-1]) == assigned(sorted(base, key=lambda r: str(r[::-1])))
    assert {r[-1] for r in first} == set(range(8)) and len(first) == 600
    equal = assigned([("hot", 1, "same")] * 400)
    assert len({r[-1] for r in equal}) == 8
    with_hot = salted(spark.createDataFrame(base, "k string, n int, v string").coalesce(1), F.when(F.col("k") == "k1", 5).otherwise(1))
    assert {r[SALT] for r in with_hot.where("k <> 'k1'").collect()} == {0} and {r[SALT] for r in with_hot.where("k = 'k1'").collect()} == set(range(5))


def _jobs(spark, run, group):
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


@pytest.mark.parametrize("name, most", [("client_membership", 4), ("host_membership", 6)])
def test_row_splits_take_few_jobs(spark, name, most):
    """Key lists come from one written table each, made by one job with its shuffles."""
    run = lambda: QUERIES[name](spark, SF_SMALL).write.format("noop").mode("overwrite").save()
    assert _jobs(spark, run, f"jobs-{name}") <= most


def test_one_job_writes_both_key_lists(spark, edge, edge_model):
    from fleetlens.plans.model import UsageModel

    m = UsageModel(edge)
    plans = _written_plans(spark, lambda: (m.host_rows().collect(), m.client_rows().collect()))
    assert [label for label, _ in plans] == ["keys-by-client"]
    got = {r.client: r.hosts for r in m._row_host_keys[0].collect()}
    assert got == {"aig": ["A", "B"], "eti": ["C"], "tuv": [], "zor": []}
    # the same from the names of a bucket table
    assert {r.client: r.hosts for r in (edge_model._pass() and edge_model._row_host_keys[0]).collect()} == got


def test_plans_are_built_with_few_calls(spark):
    """Expressions are SQL text: a report's plan takes hundreds of calls to the JVM, not thousands."""
    import py4j.java_gateway as gateway

    calls = [0]
    send = gateway.GatewayClient.send_command

    def counted(self, *args, **kwargs):
        calls[0] += 1
        return send(self, *args, **kwargs)

    gateway.GatewayClient.send_command = counted
    try:
        for name in ("host_totals", "fleet_report"):
            calls[0] = 0
            QUERIES[name](spark, SF_SMALL)
            assert calls[0] < 1500, (name, calls[0])
    finally:
        gateway.GatewayClient.send_command = send


def test_broadcast_limit_from_session(spark):
    from fleetlens.runtime import broadcast_limit

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20MB")
        assert broadcast_limit(spark) == 20 * 1024 * 1024
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert broadcast_limit(spark) == -1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hourly_profile_plan_shape(spark):
    df = QUERIES["hourly_profile_host"](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    # the bucket data is shuffled once, for the final aggregation; the other
    # exchanges are the small key distincts, and every join is a broadcast
    data_shuffles = [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln and "bucket" in ln]
    assert len(data_shuffles) == 1, plan
    assert "BroadcastHashJoin" in plan


def test_bucket_pass_prunes_columns(spark):
    import tempfile

    from pyspark.sql import functions as F

    from conftest import EDGE_ROWS
    from fleetlens.operators.aggregates import server_buckets
    from fleetlens.sources.scan import CANONICAL_SCHEMA, scan_metrics

    d = tempfile.mkdtemp(prefix="fleetlens-test-") + "/wide"
    wide = spark.createDataFrame(EDGE_ROWS, CANONICAL_SCHEMA).withColumn("payload", F.lit("x" * 100))
    wide.write.parquet(d)
    plan = _plan(server_buckets(scan_metrics(spark, d)))
    read = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "payload" not in read
    assert read.startswith("struct<server_name:string,processor:string,hr_time:timestamp_ntz,avg_processor_time:double")
