from fleetlens.operators.aggregates import (  # noqa: F401
    ALL,
    profile,
    profile_rollup,
    server_buckets,
    total_usage,
    total_usage_projected,
)
from fleetlens.operators.filters import (  # noqa: F401
    derive_keys,
    filter_client_host,
    filter_client_total,
    filter_datepart_eq,
    filter_total,
    project_dateparts,
)
from fleetlens.operators.joins import keyed_join  # noqa: F401
from fleetlens.operators.keys import (  # noqa: F401
    client_key_list,
    distinct_clients,
    distinct_dateparts,
    distinct_hosts,
    host_key_list,
    host_keys,
    keys_by_client,
    server_names,
)
from fleetlens.operators.membership import (  # noqa: F401
    attach,
    client_members,
    host_members,
    positional_client_members,
    positional_host_members,
)
from fleetlens.operators.shares import client_share, client_totals, host_share, host_totals, usage_averages  # noqa: F401
