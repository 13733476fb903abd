"""Totals, shares and report averages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.columns import MONTH_HOURS, SERVER, WEEK_HOURS, percent, percent_sql, round_half_up, round_half_up_sql
from fleetlens.operators.aggregates import ALL
from fleetlens.operators.joins import keyed_join


def _server_totals(buckets: DataFrame) -> DataFrame:
    return buckets.where(f"profile = '{ALL}'").select(SERVER, "total")


def host_totals(buckets: DataFrame, host_members: DataFrame, broadcast: bool = True) -> DataFrame:
    """(client, host, total): a host's sum over every name it occurs in."""
    joined = keyed_join(_server_totals(buckets), host_members, SERVER, broadcast=broadcast)
    return joined.groupBy("client", "host").agg(F.expr("sum(total) AS total"))


def client_totals(buckets: DataFrame, client_members: DataFrame, key_list: DataFrame, broadcast: bool = True) -> DataFrame:
    """(client, total) from client membership (not from the host split, which
    counts overlapping names twice). Clients with no ``_Total`` rows keep a
    null total: every key of ``key_list`` (it may repeat them) takes part with
    a null, and one aggregation serves both. ``broadcast``: the membership map
    is proven small."""
    joined = keyed_join(_server_totals(buckets), client_members, SERVER, broadcast=broadcast).select("client", "total")
    every = key_list.selectExpr("client", f"CAST(NULL AS {buckets.schema['total'].dataType.simpleString()}) AS total")
    return joined.union(every).groupBy("client").agg(F.expr("sum(total) AS total"))


def host_share(host_totals: DataFrame, digits: int = 1) -> DataFrame:
    """Each host's percent of the SUM OF ITS CLIENT'S HOST TOTALS (with
    overlapping names this exceeds the client total, as in the original).

    The denominator is a window sum per client. A window group holds one row
    per host of the client, and host keys are single characters, so the group
    stays small however many samples the client has."""
    pct = percent_sql("total", "sum(total) OVER (PARTITION BY client)")
    shares = host_totals.selectExpr("client", "host", "CAST(total AS DOUBLE) AS total", f"{pct} AS pct")
    return shares.selectExpr("*", f"{round_half_up_sql('pct', digits)} AS pct_1dp")


def client_share(client_totals: DataFrame, digits: int = 1) -> DataFrame:
    """Each client's percent of the fleet total. The fleet total is a scalar
    subquery (partial sums per task, one final row), not a global window."""
    fleet = client_totals.select(F.sum("total")).scalar()
    pct = percent("total", fleet)
    return client_totals.select("client", F.expr("CAST(total AS DOUBLE) AS total"), pct.alias("pct"), round_half_up(pct, digits).alias("pct_1dp"))


def usage_averages(host_totals: DataFrame) -> DataFrame:
    """Report averages per host: month = total / (31*24), week = total / (4*7*24)."""
    t = "CAST(total AS DOUBLE)"
    return host_totals.selectExpr("client", "host", f"{t} AS total", f"{t} / {MONTH_HOURS} AS month_avg", f"{t} / {WEEK_HOURS} AS week_avg")
