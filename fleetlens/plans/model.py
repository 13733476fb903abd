"""UsageModel: the reduced, durable tables every report reads.

The raw sample table is read by one aggregation pass: the per-server bucket sums
for the profiles that a report needs, plus one row per server name (partially
aggregated, see ``server_buckets``). It is written as Parquet under the
session's checkpoint directory, which cuts its lineage (a lost executor
re-reads the written table, not the raw data) and gives the planner its true
size. Everything after that works on at most ``#servers x 63`` rows: client
keys, membership (an equi-join per distinct name), profiles, totals, shares
and reports are DataFrames over this table. Row-level splits read the raw rows
once more and match each where it is read.
"""

from __future__ import annotations

from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.columns import CLIENT_SQL, MONTH_HOURS, PROFILES, SERVER, WEEK_HOURS, client_key, host_key, percent_sql, round_half_up_sql
from fleetlens.operators import aggregates as agg
from fleetlens.operators import filters, keys, membership, shares
from fleetlens.operators.joins import SALTS
from fleetlens.runtime import Table, broadcast_limit, fits_broadcast, materialize, shuffle_partitions

REPORT_COLUMNS = ("client", "host", "profile", "bucket", "total", "value", "value_1dp")


class UsageModel:
    """Reports over one sample table. Nothing runs until the first report is
    asked for; the bucket table with the profiles it needs is then written, and
    later reports read it if it has theirs too."""

    def __init__(
        self,
        samples: DataFrame,
        membership: str = "contains",
        max_broadcast_bytes: int | None = None,
        reuse_members: bool = False,
    ):
        """``reuse_members``: for many reports from one model. The first pass
        computes all profiles, and the (names-level) membership maps are kept
        cached; the first report's job fills the cache, ``close()`` releases
        it. Off by default: each report then re-derives them from the written
        bucket table (cheap, nothing held)."""
        if membership not in ("contains", "positional"):
            raise ValueError("membership must be 'contains' or 'positional'")
        self.samples = samples
        self.membership = membership
        self.max_broadcast_bytes = max_broadcast_bytes  # None: the session's broadcast threshold
        self.reuse_members = reuse_members
        self._held: list[DataFrame] = []
        self._tables: list[Table] = []
        self._passes: dict[frozenset[str], Table] = {}

    def _keep(self, df: DataFrame) -> DataFrame:
        if not self.reuse_members:
            return df
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        self._held.append(df)
        return df

    def _write(self, df: DataFrame, label: str, *args, **kwargs) -> Table:
        table = materialize(df, label, *args, **kwargs)
        self._tables.append(table)
        return table

    def close(self, delete: bool = False) -> None:
        """Release cached maps; with ``delete``, also remove the tables that
        this model wrote: its DataFrames cannot be read any more."""
        for df in self._held:
            df.unpersist()
        self._held.clear()
        if delete:
            for table in self._tables:
                table.delete()
            self._tables.clear()

    def __enter__(self) -> UsageModel:
        return self

    def __exit__(self, *exc) -> None:
        self.close()

    # -- reduced tables ----------------------------------------------------
    def _pass(self, profiles=()) -> Table:
        """The written bucket table with (at least) these profiles."""
        wanted = frozenset(PROFILES if self.reuse_members else profiles)
        for has, table in self._passes.items():
            if wanted <= has:
                return table
        in_order = [p for p in PROFILES if p in wanted]
        # one directory per profile: a report reads only the profiles it needs
        table = self._write(agg.server_buckets(self.samples, in_order), "buckets", _bucket_metrics(), partition_by=("profile",))
        self._passes[wanted] = table
        return table

    @property
    def _names_table(self) -> Table:
        """Any bucket table: each has a row for every name."""
        return next(iter(self._passes.values()), None) or self._pass()

    @property
    def buckets(self) -> DataFrame:
        """The bucket table with all profiles."""
        return self._pass(PROFILES).df

    def _bound(self, name: str) -> int:
        return int(self._names_table.metrics[name] or 0)

    @property
    def _name_rows(self) -> DataFrame:
        return self._names_table.df.where(f"profile = '{agg.ALL}'")

    @cached_property
    def clients(self) -> DataFrame:
        """Client keys of ALL rows, from the bucket table's per-name rows."""
        return keys.distinct_clients(self._name_rows)

    @cached_property
    def names(self) -> DataFrame:
        """Distinct names that have ``_Total`` rows."""
        return self._name_rows.where("has_total").select(SERVER)

    @property
    def _key_lengths(self) -> list[int]:
        return sorted(n for n in self._names_table.metrics["key_lengths"] if n and n > 0) or [3]

    def _limit(self) -> int:
        return broadcast_limit(self.samples.sparkSession) if self.max_broadcast_bytes is None else self.max_broadcast_bytes

    def _sized(self, df: DataFrame, bound: str, label: str) -> tuple[DataFrame, bool, int]:
        """(frame, proven to fit the broadcast limit, best known size bound).
        Within the write-time bound the frame stays a cheap lazy names-level
        join; when the bound is too loose to decide, it is written once (exact
        size observed by that write, and durable) rather than measured and
        recomputed."""
        limit = self._limit()
        if limit > 0 and self._bound(bound) <= limit:
            return self._keep(df), True, self._bound(bound)
        table = self._write(df, label)
        return table.df, 0 < limit and table.bytes <= limit, table.bytes

    @cached_property
    def _client_members(self) -> tuple[DataFrame, bool, int]:
        if self.membership == "positional":
            cm = membership.positional_client_members(self.names)
        else:
            key_side, fits = self._key_side(self._client_key_list, self.clients, "client_key_bytes")
            cm = membership.client_members(self.names, key_side, self._key_lengths, broadcast=fits)
        return self._sized(cm, "client_member_bytes", "client-members")

    @property
    def client_members(self) -> DataFrame:
        """(server_name, client); a names-level join over the written bucket table."""
        return self._client_members[0]

    @cached_property
    def host_keys(self) -> DataFrame:
        return keys.host_keys(self.client_members)

    @cached_property
    def _host_members(self) -> tuple[DataFrame, bool, int]:
        if self.membership == "positional":
            hm = membership.positional_host_members(self.client_members)
        else:
            # one host-key row per client-member row, each no larger: the
            # members' size (exact once written) bounds the key list
            key_list = keys.host_key_list(self.client_members)
            key_side, fits = self._key_side(key_list, self.host_keys, self._client_members[2])
            hm = membership.host_members(self.client_members, key_side, broadcast=fits)
        return self._sized(hm, "host_member_bytes", "host-members")

    @property
    def host_members(self) -> DataFrame:
        """(server_name, client, host)."""
        return self._host_members[0]

    @property
    def _client_key_list(self) -> DataFrame:
        return keys.client_key_list(self._name_rows)

    def _key_side(self, key_list: DataFrame, distinct_keys: DataFrame, bound: str | int) -> tuple[DataFrame, bool]:
        """The key side of a membership semi join: the plain key list (one
        row per name or member row, repeats kept) broadcast when its
        write-time bound fits, so no shuffle is needed to de-duplicate it;
        otherwise the distinct keys, broadcast if they fit, else joined by a
        salted sort-merge join."""
        limit = self._limit()
        known = bound if isinstance(bound, int) else self._bound(bound)
        if limit > 0 and known <= limit:
            return key_list, True
        return distinct_keys, fits_broadcast(distinct_keys, self.max_broadcast_bytes, bound=known)

    @property
    def _cm_fits(self) -> bool:
        return self._client_members[1]

    @property
    def _hm_fits(self) -> bool:
        return self._host_members[1]

    # The key lists of the row-level splits are written once, each by one job: from
    # the names of a bucket table if there is one, else from the rows themselves.
    def _written_keys(self, df: DataFrame, label: str, more_bytes: str = "0") -> tuple[DataFrame, bool, list[int]]:
        """(one row a client, whether proven to fit the broadcast limit, the keys' lengths)."""
        table = self._write(df, label, {"more_bytes": F.expr(f"sum({more_bytes})"), "key_lengths": F.expr("collect_set(length(client))")})
        size = table.bytes + int(table.metrics["more_bytes"] or 0)
        return table.df, 0 < self._limit() and size <= self._limit(), sorted(table.metrics["key_lengths"]) or [3]

    @cached_property
    def _row_host_keys(self) -> tuple[DataFrame, bool, list[int]]:
        """(client, hosts)"""
        names = self._name_rows.select(SERVER, "has_total") if self._passes else keys.server_names(self.samples)
        return self._written_keys(keys.keys_by_client(names), "keys-by-client", "coalesce(size(hosts), 0) * 24L")

    @cached_property
    def _row_client_keys(self) -> tuple[DataFrame, bool, list[int]]:
        """(client)"""
        if "_row_host_keys" in self.__dict__:
            return self._row_host_keys
        return self._written_keys(self.clients if self._passes else keys.distinct_clients(self.samples), "client-keys")

    @cached_property
    def hot_servers(self) -> DataFrame:
        """Servers holding more ``_Total`` rows than an evenly filled shuffle
        partition would (total / P, P = spark.sql.shuffle.partitions), with
        the number of salts that splits each into partition-sized pieces
        (capped at P). Fewer than P servers can qualify, so the list is
        bounded by the partition count, whatever the data."""
        parts = shuffle_partitions(self.samples.sparkSession)
        total = self._bound("total_rows")
        threshold = max(1, -(-total // parts))
        salts = F.least(F.ceil(F.col("rows") / F.lit(threshold)), F.lit(parts)).cast("int")
        hot = self._name_rows.where(F.col("rows") > threshold)
        return hot.select(SERVER, salts.alias(SALTS))

    # -- row-level splits ------------------------------------------------
    def client_rows(self) -> DataFrame:
        """Every ``_Total`` row once per client whose key its name contains.

        The rows are matched where they are read, against the broadcast list of
        client keys; only a key list over the broadcast limit makes it a
        (salted) join with the members of each name."""
        rows = filters.filter_total(self.samples).where(f"{SERVER} IS NOT NULL")
        if self.membership == "positional":
            out = rows.withColumn("client", client_key(SERVER)).where("client <> ''")
        elif self._row_client_keys[1]:
            clients, _, lengths = self._row_client_keys
            out = membership.rows_by_client(rows, clients, lengths)
        else:
            out = membership.attach(rows, self.client_members, broadcast=self._cm_fits, hot=self.hot_servers)
        return out.select("client", *self.samples.columns)

    def host_rows(self) -> DataFrame:
        """Every ``_Total`` row once per (client, host) it belongs to."""
        if self.membership == "positional":
            out = self.client_rows().withColumn("host", host_key(SERVER)).where("host <> ''")
        elif self._row_host_keys[1]:
            by_client, _, lengths = self._row_host_keys
            rows = filters.filter_total(self.samples).where(f"{SERVER} IS NOT NULL")
            out = membership.rows_by_host(rows, by_client, lengths)
        else:
            rows = filters.filter_total(self.samples)
            out = membership.attach(rows, self.host_members, broadcast=self._hm_fits, hot=self.hot_servers)
        return out.select("client", "host", *self.samples.columns)

    # -- profiles ----------------------------------------------------------
    def profile(self, part: str, level: str = "host", divisor: float | None = None) -> DataFrame:
        if part not in PROFILES:
            raise ValueError(f"unknown date part {part!r}; expected one of {PROFILES}")
        if level == "host":
            return agg.profile(self._pass([part]).df, self.host_members, ["client", "host"], part, divisor, broadcast=self._hm_fits)
        if level == "client":
            return agg.profile(self._pass([part]).df, self.client_members, ["client"], part, divisor, broadcast=self._cm_fits)
        raise ValueError("level must be 'host' or 'client'")

    # -- totals and shares -------------------------------------------------
    def host_totals_raw(self) -> DataFrame:
        return shares.host_totals(self._pass().df, self.host_members, broadcast=self._hm_fits)

    def client_totals_raw(self) -> DataFrame:
        return shares.client_totals(self._pass().df, self.client_members, self._client_key_list, broadcast=self._cm_fits)

    def host_totals(self) -> DataFrame:
        return self.host_totals_raw().selectExpr("client", "host", "CAST(total AS DOUBLE) AS total")

    def client_totals(self) -> DataFrame:
        return self.client_totals_raw().selectExpr("client", "CAST(total AS DOUBLE) AS total")

    def host_share(self) -> DataFrame:
        return shares.host_share(self.host_totals_raw())

    def client_share(self) -> DataFrame:
        return shares.client_share(self.client_totals_raw())

    def usage_averages(self) -> DataFrame:
        return shares.usage_averages(self.host_totals_raw())

    # -- reports -----------------------------------------------------------
    def host_rollup(self) -> DataFrame:
        """One join + one aggregation for all three profiles and the host
        totals: ``(client, host, profile, bucket, total)``."""
        buckets = self.buckets  # first: the maps are then derived from this pass
        return agg.profile_rollup(
            buckets, self.host_members, ["client", "host"], (*PROFILES, agg.ALL), broadcast=self._hm_fits
        )

    def client_report(self) -> DataFrame:
        """Tidy chart data for every client and host:
        ``(client, host, profile, bucket, total, value, value_1dp)``; profile is
        ``hour``, ``weekday``, ``monthday`` (value = total / divisor), ``share``
        (value = percent of the client's host sum; ``value_1dp`` is the pie
        label, to one decimal), ``month_avg`` or ``week_avg`` (value = total
        over the hours of a month, or of four weeks). ``bucket`` is a double: one
        x-axis column for every chart, null where a chart has no x (the same
        in every engine, unlike a nullable integer).

        One join + one aggregation yields every profile point and the host
        totals; the share denominators are a window sum per client over those
        rows (at most hosts x 63 of them, hosts being single characters)."""
        is_all, total, none = f"profile = '{agg.ALL}'", "CAST(total AS DOUBLE)", "CAST(NULL AS DOUBLE)"
        client_sum = f"sum(CASE WHEN {is_all} THEN total END) OVER (PARTITION BY client)"
        shared = self.host_rollup().selectExpr("*", f"CASE WHEN {is_all} THEN {percent_sql('total', client_sum)} END AS share")
        point = lambda name, value, label=none: f"struct({name} AS profile, {value} AS value, {label} AS value_1dp)"
        of_host = ", ".join(
            (
                point("'share'", "share", round_half_up_sql("share")),
                point("'month_avg'", f"{total} / {MONTH_HOURS}"),
                point("'week_avg'", f"{total} / {WEEK_HOURS}"),
            )
        )
        points = f"inline(CASE WHEN {is_all} THEN array({of_host}) ELSE array({point('profile', f'{total} / {agg.divisor_sql()}')}) END)"
        return shared.selectExpr("client", "host", "CAST(bucket AS DOUBLE) AS bucket", f"{total} AS total", points).select(*REPORT_COLUMNS)

    def fleet_report(self) -> DataFrame:
        """Every client's report plus one ``client_share`` row per client
        (host null, value = percent of the fleet, value_1dp its label)."""
        report = self.client_report()
        cs = self.client_share().selectExpr(
            "client", "CAST(NULL AS STRING) AS host", "'client_share' AS profile", "CAST(NULL AS DOUBLE) AS bucket", "total", "pct AS value", "pct_1dp AS value_1dp"
        )
        return report.union(cs)


def _bucket_metrics() -> dict:
    """Observed while the bucket table is written; upper bounds (estimated
    bytes, as ``runtime.row_bytes`` counts them) for the tables derived from
    it, so none of them needs a sizing job:

    * client keys: one short string per name at most;
    * client members: a name of L characters contains at most 3L distinct keys
      (substrings of length 1-3), each row the name, a key of <= 12 bytes and
      the row overhead;
    * host members: each client-member row matches at most L distinct
      characters, each row one more string of <= 4 bytes.
    """
    is_name = f"profile = '{agg.ALL}'"
    cm_row = f"(octet_length({SERVER}) + {16 + 8 + 12 + 8}L)"
    n = f"CAST(length({SERVER}) AS BIGINT)"
    sums = {
        "names": f"CASE WHEN {is_name} THEN 1L END",
        "total_rows": f"CASE WHEN {is_name} THEN rows END",
        "client_key_bytes": f"CASE WHEN {is_name} THEN {16 + 8 + 12}L END",
        "client_member_bytes": f"CASE WHEN {is_name} AND has_total THEN 3 * {n} * {cm_row} END",
        "host_member_bytes": f"CASE WHEN {is_name} AND has_total THEN 3 * {n} * {n} * ({cm_row} + 12) END",
    }
    return {k: F.expr(f"sum({v})") for k, v in sums.items()} | {"key_lengths": F.expr(f"collect_set(CASE WHEN {is_name} THEN length({CLIENT_SQL}) END)")}
