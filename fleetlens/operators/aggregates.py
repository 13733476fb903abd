"""Sums and usage profiles.

Every profile is "sum of the metric in a bucket / fixed constant" (not a
mean over rows). Sums keep the metric's own type (exact for DECIMAL input);
results are cast to double at the end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.columns import DATE_PART_SQL, METRIC, PROFILE_DIVISORS, PROFILES, SERVER, TOTAL_SQL, as_double
from fleetlens.operators.joins import keyed_join

ALL = "all"  # profile name of the per-server grand total rows
BUCKET_COLUMNS = ("server_name", "profile", "bucket", "total", "has_total", "rows")


def total_usage(df: DataFrame, metric: str = METRIC) -> DataFrame:
    """One row: sum of the metric (null for no rows or only nulls)."""
    return df.agg(as_double(F.sum(metric)).alias("total"))


def total_usage_projected(df: DataFrame, metric: str = METRIC) -> DataFrame:
    """``select(metric).groupBy().sum()``: sums every numeric column of the
    projection (just the metric)."""
    out = df.select(metric).groupBy().sum()
    return out.select(as_double(F.col(f"`sum({metric})`")).alias("total"))


def server_buckets(samples: DataFrame, profiles: Sequence[str] = PROFILES) -> DataFrame:
    """Per-server partial sums for the given profiles, in ONE pass over the rows.

    Output ``(server_name, profile, bucket, total, has_total, rows)``, where
    ``rows`` counts the ``_Total`` rows behind each sum (on the 'all' rows it
    tells which servers are hot):

    * ``profile`` in ``profiles``: bucket = date part, total = sum over the
      server's ``_Total`` rows in that bucket;
    * ``profile = 'all'``, bucket null: one row for EVERY server name (also
      names without ``_Total`` rows, which client keys are taken from), with
      total = sum over its ``_Total`` rows (null-time rows included) and
      ``has_total`` telling whether it has any.

    Each ``_Total`` row is expanded (``inline``) into its 'all' row and one
    bucket row per profile; any other row into its 'all' row only. Without
    profiles nothing is expanded and the time column is not read. Physical plan:
    scan -> Generate -> partial HashAggregate -> shuffle of at most one row per
    (server, profile, bucket) per task -> final HashAggregate. A server holding
    a third of all rows is collapsed inside every map task, so that shuffle is
    never skewed by it. Rows without a time give no bucket (they stay in 'all').
    """
    t = f"coalesce({TOTAL_SQL}, false)"
    whole = f"struct('{ALL}' AS profile, CAST(NULL AS INT) AS bucket)"
    parts = [f"struct('{p}' AS profile, {DATE_PART_SQL[p]} AS bucket)" for p in profiles]
    own = [f"inline(CASE WHEN {t} THEN array({', '.join([whole, *parts])}) ELSE array({whole}) END)"] if parts else [f"'{ALL}' AS profile", "CAST(NULL AS INT) AS bucket"]
    rows = samples.where(f"{SERVER} IS NOT NULL").selectExpr(SERVER, f"CASE WHEN {t} THEN {METRIC} END AS m", f"{t} AS t", *own)
    sums = [F.expr(x) for x in ("sum(m) AS total", "bool_or(t) AS has_total", "count(CASE WHEN t THEN 1 END) AS rows")]
    g = rows.groupBy(SERVER, "profile", "bucket").agg(*sums)
    return g.where(f"profile = '{ALL}' OR bucket IS NOT NULL")


def divisor_sql(profile_col: str = "profile") -> str:
    """CASE profile WHEN 'hour' THEN 31 WHEN 'weekday' THEN 96 ... END."""
    return f"CASE {profile_col} {' '.join(f"WHEN '{p}' THEN {d}" for p, d in PROFILE_DIVISORS.items())} END"


def profile_rollup(
    buckets: DataFrame, members: DataFrame, keys: Sequence[str], profiles: Sequence[str] = PROFILES, broadcast: bool = True
) -> DataFrame:
    """Sum per-server bucket totals over group members:
    ``(keys..., profile, bucket, total)`` with total still in the metric type.
    Both sides have few rows per server, so a non-broadcast join needs no salt."""
    b = buckets.where(f"profile IN ({', '.join(f"'{p}'" for p in profiles)})")
    joined = keyed_join(b, members, SERVER, broadcast=broadcast)
    return joined.groupBy(*keys, "profile", "bucket").agg(F.expr("sum(total) AS total"))


def profile(
    buckets: DataFrame,
    members: DataFrame,
    keys: Sequence[str],
    part: str,
    divisor: float | None = None,
    broadcast: bool = True,
) -> DataFrame:
    """One profile: ``(keys..., <part>, total, value = total / divisor)``.

    Only buckets present in the data appear (no zero fill); an all-null bucket
    gives a null total and value.
    """
    d = PROFILE_DIVISORS[part] if divisor is None else divisor
    r = profile_rollup(buckets, members, keys, [part], broadcast=broadcast)
    return r.selectExpr(*keys, f"bucket AS {part}", "CAST(total AS DOUBLE) AS total", f"CAST(total AS DOUBLE) / {d} AS value")
