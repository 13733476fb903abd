"""The driver-side edge: one client's charts at a time.

Rows reach the driver only here, and only one client's report rows: hosts are
single characters, and a host has at most 63 points. Drawing is left to the
caller's plotting library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Day names for Spark's dayofweek numbers 1..7 (1 = Sunday).
WEEKDAY_NAMES = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]


PROFILES = ("hour", "weekday", "monthday")
AVERAGES = ("month_avg", "week_avg")


def client_charts(report: DataFrame, client: str) -> dict[str, dict]:
    """Everything the charts of one client show, in one action.

    ``hosts``: by host (sorted), for each profile the points ``x`` (buckets
    present, sorted) and ``y``, with ``labels`` for weekdays, and the two
    averages. ``pie``: hosts with their totals, shares and one-decimal labels.
    """
    found = report.where((F.col("client") == client) & F.col("host").isNotNull()).collect()
    hosts: dict[str, dict] = {}
    for r in sorted(found, key=lambda r: (r["host"], r["profile"], r["bucket"] if r["bucket"] is not None else -1.0)):
        of = hosts.setdefault(r["host"], {p: {"x": [], "y": []} for p in PROFILES})
        if r["profile"] in PROFILES:
            of[r["profile"]]["x"].append(r["bucket"])
            of[r["profile"]]["y"].append(r["value"])
            if r["profile"] == "weekday":
                of["weekday"].setdefault("labels", []).append(WEEKDAY_NAMES[int(r["bucket"]) - 1])
        elif r["profile"] in AVERAGES:
            of[r["profile"]] = r["value"]
    slices = sorted((r for r in found if r["profile"] == "share"), key=lambda r: r["host"])
    pie = {name: [r[c] for r in slices] for name, c in (("labels", "host"), ("sizes", "total"), ("pct", "value"), ("pct_1dp", "value_1dp"))}
    return {"hosts": hosts, "pie": pie}


def chart_series(report: DataFrame, client: str, host: str, profile: str) -> dict[str, list]:
    """One profile chart of one host; for several, see ``client_charts``."""
    only = report.where((F.col("host") == host) & (F.col("profile") == profile))
    return client_charts(only, client)["hosts"].get(host, {}).get(profile, {"x": [], "y": []})


def pie_slices(report: DataFrame, client: str) -> dict[str, list]:
    """The pie of one client's hosts."""
    return client_charts(report.where(F.col("profile") == "share"), client)["pie"]


def schema_text(df: DataFrame) -> str:
    """The tree ``printSchema`` shows, as a string."""
    return df.schema.treeString()
