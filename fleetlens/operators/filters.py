"""Row filters and projections over the canonical sample table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.columns import METRIC, PROCESSOR, SERVER, TIME, client_key, date_part, host_key, is_total


def filter_total(df: DataFrame) -> DataFrame:
    """Rows whose processor instance contains ``_Total`` (pushed to the scan
    as a ``StringContains`` filter)."""
    return df.filter(is_total(PROCESSOR))


def filter_client_total(df: DataFrame, client: str) -> DataFrame:
    """Rows of one client: name contains the key AND processor is a total."""
    return df.filter(F.col(SERVER).contains(client) & is_total(PROCESSOR))


def filter_client_host(df: DataFrame, client: str, host: str) -> DataFrame:
    """Rows of one host inside one client (both substring tests)."""
    return filter_client_total(df, client).filter(F.col(SERVER).contains(host))


def filter_datepart_eq(df: DataFrame, part: str, value: int) -> DataFrame:
    """Rows whose hour / weekday / month day equals ``value`` (nulls never match)."""
    return df.filter(date_part(part, TIME) == F.lit(value))


def project_dateparts(df: DataFrame) -> DataFrame:
    """Server, time and the three date parts the profiles bucket on."""
    return df.select(
        SERVER,
        TIME,
        date_part("hour").alias("hour"),
        date_part("weekday").alias("weekday"),
        date_part("monthday").alias("monthday"),
    )


def derive_keys(df: DataFrame) -> DataFrame:
    """Add positional ``client`` (chars 1-3) and ``host`` (char 5) columns."""
    return df.select(SERVER, PROCESSOR, TIME, METRIC, client_key().alias("client"), host_key().alias("host"))
