"""Group membership by substring containment, planned as equi-joins.

A row belongs to client ``c`` when its server name contains ``c`` anywhere,
and to host ``h`` of that client when the name also contains ``h``. Groups may
overlap. Membership depends only on the server name, so it is worked out once
per distinct name (never per row) and the result is joined back on the name.

``contains(name, key)`` for keys of length k equals "key is one of the
length-k substrings of name". Exploding each distinct name into its substrings
and joining on equality gives exactly the containment matches with a hash join,
where a literal ``contains`` condition would force a nested-loop join of
names x keys.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.columns import CLIENT_SQL, HOST_SQL, SERVER, substrings_sql
from fleetlens.operators.joins import DEFAULT_SALTS, keyed_join


def key_candidates_sql(name: str, key_lengths: Iterable[int]) -> str:
    """The distinct substrings of ``name`` that could be client keys, as SQL text."""
    parts = [f"coalesce({substrings_sql(name, k)}, CAST(array() AS ARRAY<STRING>))" for k in sorted(set(key_lengths))]
    return f"array_distinct(concat({', '.join(parts)}))"


def key_candidates(name: str, key_lengths: Iterable[int]) -> Column:
    """The distinct substrings of ``name`` that could be client keys."""
    return F.expr(key_candidates_sql(name, key_lengths))


def rows_by_client(rows: DataFrame, clients: DataFrame, key_lengths: Iterable[int] = (1, 2, 3)) -> DataFrame:
    """Row-level split: every row once per client key that its name contains.
    ``clients`` (distinct keys) is proven small and broadcast, so each row is
    matched where it is read: the rows are not shuffled, whoever is hot."""
    named = rows.withColumn("client", F.explode(key_candidates(SERVER, key_lengths)))
    return named.join(F.broadcast(clients.select("client")), "client", "left_semi")


def rows_by_host(rows: DataFrame, keys: DataFrame, key_lengths: Iterable[int] = (1, 2, 3)) -> DataFrame:
    """Row-level split: every row once per client key that its name contains
    and host key of that client that it contains too. ``keys`` (client, hosts;
    one row a client, proven small) is broadcast: one join serves both."""
    named = rows.withColumn("client", F.explode(key_candidates(SERVER, key_lengths)))
    met = named.join(F.broadcast(keys.select("client", "hosts")), "client")
    return met.withColumn("host", F.expr(f"explode(filter(hosts, h -> contains({SERVER}, h)))")).drop("hosts")


def client_members(
    names: DataFrame,
    clients: DataFrame,
    key_lengths: Iterable[int] = (1, 2, 3),
    broadcast: bool = True,
    salts: int = DEFAULT_SALTS,
) -> DataFrame:
    """(server_name, client) for every distinct name and every client key it
    contains. ``names`` has one row per name; ``clients`` lists the keys (it
    may repeat them: the match is a semi join) and ``key_lengths`` must cover
    their lengths. ``broadcast``: the key list is proven small; otherwise a
    salted sort-merge join (many names may share one client key)."""
    exploded = names.select(SERVER, F.explode(key_candidates(SERVER, key_lengths)).alias("client"))
    joined = keyed_join(exploded, clients.select("client"), "client", broadcast=broadcast, how="left_semi", salts=salts)
    return joined.select(SERVER, "client")


def host_members(client_members: DataFrame, hosts: DataFrame, broadcast: bool = True, salts: int = DEFAULT_SALTS) -> DataFrame:
    """(server_name, client, host) for every host key of the name's client
    that occurs anywhere in the name (host keys are single characters;
    ``hosts`` may repeat them: the match is a semi join)."""
    chars = client_members.selectExpr(SERVER, "client", f"explode(array_distinct({substrings_sql(SERVER, 1)})) AS host")
    joined = keyed_join(chars, hosts.select("client", "host"), ["client", "host"], broadcast=broadcast, how="left_semi", salts=salts)
    return joined.select(SERVER, "client", "host")


def positional_client_members(names: DataFrame) -> DataFrame:
    """Disjoint variant: the client is the name's own prefix only."""
    return names.selectExpr(SERVER, f"{CLIENT_SQL} AS client").where("client <> ''")


def positional_host_members(client_members: DataFrame) -> DataFrame:
    """Disjoint variant: the host is the name's own fifth character only."""
    return client_members.selectExpr(SERVER, "client", f"{HOST_SQL} AS host").where("host <> ''")


def attach(
    rows: DataFrame, members: DataFrame, broadcast: bool = True, salts: int = DEFAULT_SALTS, hot: DataFrame | None = None
) -> DataFrame:
    """Row-level split, for key lists too large to broadcast (else see
    ``rows_by_client``): every row once per group its name belongs to.

    With ``broadcast`` (the caller proved ``members`` small) the rows are not
    shuffled at all. Otherwise the join is salted, so a server holding a large
    share of all rows is spread over ``salts`` partitions; ``hot`` (server
    names, a bounded list) limits the salting to those servers."""
    return keyed_join(rows, members, SERVER, broadcast=broadcast, salts=salts, hot=hot)
