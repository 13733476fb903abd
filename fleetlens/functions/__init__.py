from fleetlens.functions.columns import (  # noqa: F401
    CLIENT_LEN,
    CLIENT_POS,
    HOST_LEN,
    HOST_POS,
    METRIC,
    MONTH_HOURS,
    PROCESSOR,
    PROFILE_DIVISORS,
    PROFILES,
    SERVER,
    TIME,
    TOTAL_MARK,
    WEEK_HOURS,
    as_double,
    client_key,
    date_part,
    host_key,
    is_total,
    percent,
    round_half_up,
    substrings,
)
