"""Command line, driven in-process with the test session."""

from conftest import EDGE_ROWS, SF_SMALL, rows

from fleetlens.__main__ import main
from fleetlens.runtime import scratch_path
from fleetlens.sources.scan import CANONICAL_SCHEMA


def test_report_command(spark, edge_model):
    src, out = scratch_path(spark, "cli-src"), scratch_path(spark, "cli-out")
    spark.createDataFrame(EDGE_ROWS, CANONICAL_SCHEMA).write.json(src)
    assert main(["report", "--input", src, "--format", "json", "--output", out], spark=spark) == 0
    got = spark.read.parquet(out).select("client", "host", "profile", "bucket", "total", "value", "value_1dp")
    assert rows(got) == rows(edge_model.fleet_report())
    out2 = scratch_path(spark, "cli-out2")
    ddl = "server_name STRING, processor STRING, hr_time TIMESTAMP_NTZ, avg_processor_time DOUBLE"
    assert main(["report", "--input", src, "--format", "json", "--schema", ddl, "--output", out2], spark=spark) == 0
    assert rows(spark.read.parquet(out2).select(*got.columns)) == rows(got)


def test_query_command(spark):
    out = scratch_path(spark, "cli-q")
    assert main(["query", "client_share", "--sf-dir", SF_SMALL, "--output", out], spark=spark) == 0
    assert spark.read.parquet(out).count() == 6
    assert main(["query", "nope", "--sf-dir", SF_SMALL, "--output", out], spark=spark) == 2


def test_report_command_positional(spark):
    import datetime as dt

    src, a, b = (scratch_path(spark, x) for x in ("cli-p-src", "cli-p-a", "cli-p-b"))
    data = [(f"{c}-{h}1", "_Total", dt.datetime(2021, 8, 2, i), float(i)) for i, (c, h) in enumerate([("aaa", "C"), ("bbb", "D"), ("aaa", "E")])]
    spark.createDataFrame(data, CANONICAL_SCHEMA).write.parquet(src)
    assert main(["report", "--input", src, "--output", a], spark=spark) == 0
    assert main(["report", "--input", src, "--membership", "positional", "--output", b], spark=spark) == 0
    cols = ["client", "host", "profile", "bucket", "total", "value"]
    assert rows(spark.read.parquet(a).select(*cols)) == rows(spark.read.parquet(b).select(*cols))


def test_load_command(spark, capsys):
    import json

    src, target, rejects = (scratch_path(spark, x) for x in ("cli-l-src", "cli-l-dst", "cli-l-bad"))
    spark.createDataFrame(
        [("aig-A0", "_Total", "2021-08-01 05:00:00", "12.5"), ("aig-A0", "_Total", "yesterday", "1")], "`Host Name` string, Processor string, HR_Time string, `AVG_%_Processor_Time` string"
    ).write.option("header", "true").csv(src)
    run = ["load", "--input", src, "--map", "Host Name=server_name", "--target", target, "--rejects", rejects, "--load-id", "2021-08"]
    for _ in range(2):  # run again: the same counts, nothing added
        assert main(run, spark=spark) == 0
        assert json.loads(capsys.readouterr().out.splitlines()[-1]) == {"loaded": 1, "rejected": 1}
    table = spark.read.parquet(target)
    assert [(r.server_name, r.hr_time.hour, r.avg_processor_time) for r in table.collect()] == [("aig-A0", 5, 12.5)]
    assert [r["reject_reason"] for r in spark.read.json(rejects).collect()] == ["time"]
    out = scratch_path(spark, "cli-l-report")
    assert main(["report", "--input", target, "--output", out], spark=spark) == 0 and spark.read.parquet(out).count() > 0
    assert main([*run[:-1], "no/id"], spark=spark) == 2 and "load id" in capsys.readouterr().err
    assert main(["load", "--input", src, "--target", target, "--mode", "error", "--map", "Host Name=server_name"], spark=spark) == 2
