"""fleetlens - CPU-usage analytics over a fleet of servers, on Spark.

From a sample table (server name, processor instance, time, average %
processor time) it derives client and host groups from server names, builds
usage profiles by hour of day, day of week and day of month, each host's
share of its client and each client's share of the fleet, and assembles them
into chart-ready report tables. Every operator is a DataFrame -> DataFrame
function that runs as a distributed Spark plan.
"""

from fleetlens.plans.model import REPORT_COLUMNS, UsageModel  # noqa: F401
from fleetlens.operators.joins import keyed_join  # noqa: F401
from fleetlens.runtime import checkpoint_root, fits_broadcast, local_session, materialize  # noqa: F401
from fleetlens.sources.scan import CANONICAL_SCHEMA, events_samples, scan_metrics  # noqa: F401

__version__ = "0.1.0"
