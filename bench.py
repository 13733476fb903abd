"""Benchmark the headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3; "queries" holds the best of N runs, "first_run" the
first one).
Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.

Each query is timed end to end: its reduced tables are built from the raw
Parquet inside the timing, and the result is executed through the ``noop``
sink (nothing is pulled to the driver). Two untimed warm-up queries run first.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "hourly_profile_host",
    "weekly_profile_host",
    "monthly_profile_host",
    "hourly_profile_client",
    "host_totals",
    "client_totals",
    "host_share",
    "client_share",
    "usage_averages",
    "client_membership",
    "host_membership",
    "client_report",
    "fleet_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "3")))
    from fleetlens.plans.registry import QUERIES
    from fleetlens.runtime import local_session

    spark = local_session(cpus, shuffle_partitions=cpus * 2, app="fleetlens-bench")

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in ("hourly_profile_host", "fleet_report"):  # warm-up (JIT, class loading)
        try:
            run(name)
        except Exception:  # the timed runs below record it
            pass
    runs = {name: [] for name in HEADLINE}
    errors = {}
    for _ in range(repeat):
        for name in HEADLINE:
            if name in errors:
                continue
            try:
                runs[name].append(run(name))
            except Exception as exc:  # keep benchmarking the others; report it
                errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    times = {name: round(min(v), 3) for name, v in runs.items() if v}
    first = {name: round(v[0], 3) for name, v in runs.items() if v}
    # The way a user runs reports: one bucket pass, then every report from it.
    from fleetlens.plans.model import UsageModel
    from fleetlens.sources.scan import events_samples

    def shared() -> float:
        t0 = time.perf_counter()
        model = UsageModel(events_samples(spark, sf_dir), reuse_members=True)
        outs = [model.profile(p) for p in ("hour", "weekday", "monthday")] + [
            model.profile("hour", level="client"),
            model.host_totals(),
            model.client_totals(),
            model.host_share(),
            model.client_share(),
            model.usage_averages(),
            model.client_report(),
            model.fleet_report(),
        ]
        for df in outs:
            df.write.format("noop").mode("overwrite").save()
        model.close()
        return time.perf_counter() - t0

    try:
        shared_sec = round(min(shared() for _ in range(repeat)), 3)
    except Exception as exc:
        shared_sec = None
        errors["shared_model"] = f"{type(exc).__name__}: {str(exc)[:200]}"
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "first_run": first,
        "first_run_total": round(sum(first.values()), 3),
        "shared_model_all_reports_sec": shared_sec,
        "cpus": cpus,
        "repeat": repeat,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
