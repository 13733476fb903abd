"""Distinct keys: clients, hosts and date-part buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.columns import CLIENT_LEN, CLIENT_SQL, HOST_SQL, SERVER, TIME, TOTAL_SQL, date_part
from fleetlens.operators.membership import key_candidates_sql


def distinct_clients(samples: DataFrame) -> DataFrame:
    """Client keys over ALL rows (before the ``_Total`` filter).

    Null and empty keys are dropped: they cannot name a client. The distinct is
    partially aggregated in every scan task, so only a handful of keys per task
    are shuffled whatever the row count.
    """
    return client_key_list(samples).distinct()


def host_key_list(client_members: DataFrame) -> DataFrame:
    """(client, host) for every member name, repeats kept: character 5 of
    every name that belongs to the client; names shorter than 5 characters
    give no host."""
    return client_members.selectExpr("client", f"{HOST_SQL} AS host").where("host <> ''")


def client_key_list(names: DataFrame) -> DataFrame:
    """Client key of every name, repeats kept (null and empty dropped)."""
    return names.selectExpr(f"{CLIENT_SQL} AS client").where("client <> ''")


def host_keys(client_members: DataFrame) -> DataFrame:
    """(client, host) keys, distinct."""
    return host_key_list(client_members).distinct()


def server_names(samples: DataFrame) -> DataFrame:
    """(server_name, has_total): each name once, and whether it has ``_Total``
    rows. A server's rows are reduced in every scan task before the shuffle."""
    return samples.where(f"{SERVER} IS NOT NULL").selectExpr(SERVER, f"coalesce({TOTAL_SQL}, false) AS t").groupBy(SERVER).agg(F.expr("bool_or(t) AS has_total"))


def keys_by_client(names: DataFrame) -> DataFrame:
    """(client, hosts): every client key with the sorted host keys of the
    ``_Total`` names that contain it, by one aggregation.

    ``names`` has one row a name, with ``has_total``. A name gives its own
    client key, and its host key to every substring that could be a client key;
    keys that no name has of its own are then dropped. Host keys are single
    characters, so a client's set is small however many names it has, and sets
    are merged map-side."""
    own = f"array(struct({CLIENT_SQL} AS client, CAST(NULL AS STRING) AS host, true AS own))"
    offered = f"transform({key_candidates_sql(SERVER, range(1, CLIENT_LEN + 1))}, c -> struct(c AS client, {HOST_SQL} AS host, false AS own))"
    offers = names.selectExpr(f"inline(CASE WHEN has_total AND {HOST_SQL} <> '' THEN concat({own}, {offered}) ELSE {own} END)").where("client <> ''")
    keyed = offers.groupBy("client").agg(F.expr("sort_array(collect_set(host)) AS hosts"), F.expr("bool_or(own) AS own"))
    return keyed.where("own").select("client", "hosts")


def distinct_hosts(client_members: DataFrame) -> DataFrame:
    """Host keys sorted by client, then host."""
    return host_keys(client_members).orderBy("client", "host")


def distinct_dateparts(df: DataFrame, part: str) -> DataFrame:
    """Sorted distinct hour / weekday / month-day values present (no nulls)."""
    return df.select(date_part(part, TIME).alias(part)).where(F.col(part).isNotNull()).distinct().orderBy(part)
