"""Named queries over the driver's test tables, one per inventory row.

Each takes ``(spark, sf_dir)`` and returns a DataFrame. The sample table is
the ``events`` table shaped as CPU samples (``events_samples``), so every
query's work grows with the given tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.columns import METRIC, SERVER, TIME
from fleetlens.operators import aggregates as agg
from fleetlens.operators import filters, keys
from fleetlens.plans.model import UsageModel
from fleetlens.runtime import delete_path, materialize, scratch_path
import fleetlens.sources.catalog as catalog
import fleetlens.sources.load as load
import fleetlens.sources.scan as scan
import fleetlens.sources.sink as sink
from fleetlens.sources.scan import events_samples, events_source

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the single-group filters (the original filtered fixed names).
ONE_CLIENT = "pur"
ONE_HOST = "A"
ONE_HOUR = 13
METRIC_TYPE = "decimal(18,2)"  # exact sums in any order
CACHE_PARTITIONS = 6  # the original's


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_samples(spark, sf_dir)


def _model(spark: SparkSession, sf_dir: str) -> UsageModel:
    return UsageModel(_samples(spark, sf_dir))


def _rows(df: DataFrame) -> DataFrame:
    """Row-level outputs carry the metric as DOUBLE, the canonical type (the
    adapter's DECIMAL(18,2) only keeps sums exact; every value converts
    exactly the same way in any engine)."""
    return df.withColumn(METRIC, F.col(METRIC).cast("double"))


def scan_metrics(spark, sf_dir):
    """The scan operator itself, over the collection's own columns and text values."""
    catalog.register_view(events_source(spark, sf_dir), "fleet_collection")
    return _rows(scan.scan_metrics(spark, table="fleet_collection", metric_type=METRIC_TYPE))


def ingest_roundtrip(spark, sf_dir):
    """A CSV export with the collection's headers, in another order, loaded by name."""
    staging = scratch_path(spark, "ingest-src")
    target = scratch_path(spark, "ingest-dst")
    source = events_source(spark, sf_dir)
    load.export(source.select(*reversed(source.columns)), staging, fmt="csv")
    loaded = load.ingest(spark, staging, target, source_format="csv", metric_type=METRIC_TYPE)
    delete_path(spark, staging)
    return _rows(loaded.table)


def sql_select_all(spark, sf_dir):
    catalog.register_view(_samples(spark, sf_dir), "fleet_samples")
    return _rows(catalog.sql_select_all(spark, "fleet_samples"))


def cached_table_scan(spark, sf_dir):
    """The cached table's rows: filtered and pruned before they are cached,
    repartitioned, written from the cache, which is then released."""
    needed = filters.filter_total(_samples(spark, sf_dir)).select(SERVER, TIME, METRIC)
    with catalog.cached_table(needed, "fleet_samples_cached", partitions=CACHE_PARTITIONS) as cached:
        return _rows(materialize(cached, "cached-rows").df)


def report_sink_roundtrip(spark, sf_dir):
    report = _model(spark, sf_dir).fleet_report()
    path = scratch_path(spark, "report")
    sink.write_report(report, path)
    return sink.read_report(spark, path, report.schema).select(*report.columns)


def filter_total(spark, sf_dir):
    return _rows(filters.filter_total(_samples(spark, sf_dir)))


def filter_client_total(spark, sf_dir):
    return _rows(filters.filter_client_total(_samples(spark, sf_dir), ONE_CLIENT))


def filter_client_host(spark, sf_dir):
    return _rows(filters.filter_client_host(_samples(spark, sf_dir), ONE_CLIENT, ONE_HOST))


def filter_datepart_eq(spark, sf_dir):
    return _rows(filters.filter_datepart_eq(_samples(spark, sf_dir), "hour", ONE_HOUR))


def project_dateparts(spark, sf_dir):
    return filters.project_dateparts(_samples(spark, sf_dir))


def derive_keys(spark, sf_dir):
    return _rows(filters.derive_keys(_samples(spark, sf_dir)))


def client_membership(spark, sf_dir):
    return _rows(_model(spark, sf_dir).client_rows())


def host_membership(spark, sf_dir):
    return _rows(_model(spark, sf_dir).host_rows())


def total_usage(spark, sf_dir):
    return agg.total_usage(filters.filter_total(_samples(spark, sf_dir)))


def total_usage_projected(spark, sf_dir):
    return agg.total_usage_projected(filters.filter_total(_samples(spark, sf_dir)))


def distinct_clients(spark, sf_dir):
    return keys.distinct_clients(_samples(spark, sf_dir)).orderBy("client")


def distinct_hosts(spark, sf_dir):
    return keys.distinct_hosts(_model(spark, sf_dir).client_members)


def _distinct_part(part):
    def q(spark, sf_dir):
        return keys.distinct_dateparts(filters.filter_total(_samples(spark, sf_dir)), part)

    q.__name__ = f"distinct_{part}s"
    return q


def hourly_profile_client(spark, sf_dir):
    return _model(spark, sf_dir).profile("hour", level="client")


def hourly_profile_host(spark, sf_dir):
    return _model(spark, sf_dir).profile("hour")


def weekly_profile_host(spark, sf_dir):
    return _model(spark, sf_dir).profile("weekday")


def monthly_profile_host(spark, sf_dir):
    return _model(spark, sf_dir).profile("monthday")


def host_totals(spark, sf_dir):
    return _model(spark, sf_dir).host_totals()


def client_totals(spark, sf_dir):
    return _model(spark, sf_dir).client_totals()


def usage_averages(spark, sf_dir):
    return _model(spark, sf_dir).usage_averages()


def host_share(spark, sf_dir):
    return _model(spark, sf_dir).host_share()


def client_share(spark, sf_dir):
    return _model(spark, sf_dir).client_share()


def client_report(spark, sf_dir):
    return _model(spark, sf_dir).client_report()


def fleet_report(spark, sf_dir):
    return _model(spark, sf_dir).fleet_report()


QUERIES: dict[str, Query] = {
    "scan_metrics": scan_metrics,
    "ingest_roundtrip": ingest_roundtrip,
    "sql_select_all": sql_select_all,
    "cached_table_scan": cached_table_scan,
    "report_sink_roundtrip": report_sink_roundtrip,
    "filter_total": filter_total,
    "filter_client_total": filter_client_total,
    "filter_client_host": filter_client_host,
    "filter_datepart_eq": filter_datepart_eq,
    "project_dateparts": project_dateparts,
    "derive_keys": derive_keys,
    "client_membership": client_membership,
    "host_membership": host_membership,
    "total_usage": total_usage,
    "total_usage_projected": total_usage_projected,
    "distinct_clients": distinct_clients,
    "distinct_hosts": distinct_hosts,
    "distinct_hours": _distinct_part("hour"),
    "distinct_weekdays": _distinct_part("weekday"),
    "distinct_monthdays": _distinct_part("monthday"),
    "hourly_profile_client": hourly_profile_client,
    "hourly_profile_host": hourly_profile_host,
    "weekly_profile_host": weekly_profile_host,
    "monthly_profile_host": monthly_profile_host,
    "host_totals": host_totals,
    "client_totals": client_totals,
    "usage_averages": usage_averages,
    "host_share": host_share,
    "client_share": client_share,
    "client_report": client_report,
    "fleet_report": fleet_report,
}
