from fleetlens.sources.catalog import cache_as_table, register_view, sql_select_all, table, uncache_table  # noqa: F401
from fleetlens.sources.load import export, ingest  # noqa: F401
from fleetlens.sources.scan import CANONICAL_SCHEMA, SOURCE_COLUMNS, canonicalize, events_samples, scan_metrics  # noqa: F401
from fleetlens.sources.sink import read_report, write_report  # noqa: F401
