"""

The original ran one Spark action per chart point (about 34 per host). This
tool times that execution strategy with this library's own operators: the
points of one client's hourly charts are taken from the distributed profile,
then each point is recomputed as its own action (client/host filter, hour
filter, global sum). It also times the one-plan profile for ALL clients
(after one untimed warm-up run).

Usage: python tools/loop_baseline.py [sf_dir] [client]
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from fleetlens.operators import aggregates, filters  # noqa: E402
from fleetlens.plans.model import UsageModel  # noqa: E402
from fleetlens.runtime import local_session  # noqa: E402
from fleetlens.sources.catalog import cache_as_table, uncache_table  # noqa: E402
from fleetlens.sources.scan import events_samples  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    client = sys.argv[2] if len(sys.argv) > 2 else "pur"
    spark = local_session(8, 8, app="loop-baseline")

    UsageModel(events_samples(spark, sf_dir)).profile("hour").count()  # warm-up (JVM, JIT)
    t0 = time.perf_counter()
    n = UsageModel(events_samples(spark, sf_dir)).profile("hour").count()
    plan_sec = time.perf_counter() - t0

    # the chart points of one client (a bounded list: hosts x 24)
    points = [
        (r.host, r.hour)
        for r in UsageModel(events_samples(spark, sf_dir)).profile("hour").where(F.col("client") == client).collect()
    ]
    table = cache_as_table(events_samples(spark, sf_dir), "loop_samples", partitions=6)
    table.count()  # fill the cache, as the original's cached view was filled
    t0 = time.perf_counter()
    for host, hour in points:
        one = filters.filter_datepart_eq(filters.filter_client_host(table, client, host), "hour", hour)
        aggregates.total_usage(one).collect()
    loop_sec = time.perf_counter() - t0
    uncache_table(spark, "loop_samples")
    print(json.dumps({
        "sf_dir": sf_dir,
        "one_action_per_point_one_client_hourly": {"client": client, "actions": len(points), "sec": round(loop_sec, 2)},
        "one_plan_all_clients_hourly": {"rows": n, "sec": round(plan_sec, 2)},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
