"""Command line: load samples, write the whole fleet report in one run.

    spark-submit run_fleetlens.py load --input /data/export --format csv --map "Host Name=server_name" \\
        --target /data/cpu_samples --rejects /data/cpu_rejects --load-id 2021-08
    spark-submit run_fleetlens.py report --input /data/cpu_samples --format parquet \\
        --output /data/reports/2021-08
    python -m fleetlens query hourly_profile_host --sf-dir /root/testdata/sf0.1 --output /tmp/out

The session comes from ``SparkSession.builder.getOrCreate()``: master, memory
and ``spark.checkpoint.dir`` are whatever spark-submit / the cluster sets.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _options(pairs: list[str]) -> dict[str, str]:
    out = {}
    for p in pairs:
        k, _, v = p.partition("=")
        out[k] = v
    return out


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="fleetlens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ld = sub.add_parser("load", help="append an export to the sample table, all or nothing")
    ld.add_argument("--input", default=None, help="export path; omit it for a connector configured by --option")
    ld.add_argument("--format", default="csv")
    ld.add_argument("--option", action="append", default=[], help="reader option key=value (repeatable)")
    ld.add_argument("--schema", default=None, help="the export's own columns as DDL")
    ld.add_argument("--map", action="append", default=[], metavar="SOURCE=CANONICAL", help="a column of the export, by its name, for a canonical one (repeatable)")
    ld.add_argument("--target", default=None, help="sample table path; omit it for a connector configured by --target-option")
    ld.add_argument("--target-format", default="parquet")
    ld.add_argument("--target-option", action="append", default=[], help="writer option key=value (repeatable)")
    ld.add_argument("--mode", choices=("append", "overwrite", "error", "ignore"), default="append")
    ld.add_argument("--partition-by", action="append", default=[], help="canonical column to partition the target by (repeatable)")
    ld.add_argument("--metric-type", default="double")
    ld.add_argument("--rejects", default=None, help="folder for rows whose time or metric does not parse; without it such a row fails the load")
    ld.add_argument("--load-id", default=None, help="name of this load; a load run again under its name adds nothing")
    r = sub.add_parser("report", help="write the fleet report, partitioned by client")
    r.add_argument("--input", default=None, help="sample table path; omit it for a connector configured by --option")
    r.add_argument("--format", default="parquet")
    r.add_argument("--option", action="append", default=[], help="reader option key=value (repeatable)")
    r.add_argument("--schema", default=None, help="source schema as DDL, e.g. 'Server_Name STRING, ...' (skips inference)")
    r.add_argument("--output", required=True)
    r.add_argument("--membership", choices=("contains", "positional"), default="contains")
    q = sub.add_parser("query", help="run one registered query over a folder of test tables")
    q.add_argument("name")
    q.add_argument("--sf-dir", required=True)
    q.add_argument("--output", required=True)
    return ap


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("fleetlens").getOrCreate()
    if args.cmd == "load":
        from fleetlens.sources.load import ingest
        from fleetlens.sources.scan import SOURCE_COLUMNS

        try:
            done = ingest(
                spark,
                args.input,
                args.target,
                source_format=args.format,
                schema=args.schema,
                target_format=args.target_format,
                mode=args.mode,
                options=_options(args.option),
                target_options=_options(args.target_option),
                partition_by=tuple(args.partition_by),
                mapping=SOURCE_COLUMNS | _options(args.map) if args.map else None,
                metric_type=args.metric_type,
                rejects_path=args.rejects,
                load_id=args.load_id,
            )
        except (ValueError, FileExistsError) as exc:
            print(f"load: {exc}", file=sys.stderr)
            return 2
        print(json.dumps({"loaded": done.loaded, "rejected": done.rejected}))
        return 0
    if args.cmd == "report":
        from fleetlens.plans.model import UsageModel
        from fleetlens.sources.scan import scan_metrics
        from fleetlens.sources.sink import write_report

        samples = scan_metrics(spark, args.input, fmt=args.format, options=_options(args.option), schema=args.schema)
        with UsageModel(samples, membership=args.membership, reuse_members=True) as model:
            write_report(model.fleet_report(), args.output)
        return 0
    from fleetlens.plans.registry import QUERIES

    if args.name not in QUERIES:
        print(f"unknown query {args.name!r}; one of: {', '.join(sorted(QUERIES))}", file=sys.stderr)
        return 2
    QUERIES[args.name](spark, args.sf_dir).write.mode("overwrite").parquet(args.output)
    return 0


if __name__ == "__main__":
    sys.exit(main())
