"""Column expressions shared by every operator.

All of them are built-in Spark SQL expressions, so they stay inside
whole-stage codegen; nothing here runs Python per row. The ones that every
report builds also exist as SQL text (``*_sql``): Spark parses a text in one
call, where the same tree put together from Python takes dozens.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values. These must equal the original analysis for results to match.
#   processor instance that carries the whole-machine figure: "_Total"
#   client key: characters 1-3 of the server name
#   host key:   character 5 of the server name
#   profile divisors: hour of day / 31 (days), day of week / 96 (4 weeks x 24
#   hours), day of month / 24 (hours)
#   report averages (our definition from the same constants):
#   month = total / (31 * 24), week = total / (4 * 7 * 24)
# ---------------------------------------------------------------------------
TOTAL_MARK = "_Total"
CLIENT_POS, CLIENT_LEN = 1, 3
HOST_POS, HOST_LEN = 5, 1
PROFILE_DIVISORS = {"hour": 31, "weekday": 4 * 24, "monthday": 24}
MONTH_HOURS = 31 * 24
WEEK_HOURS = 4 * 7 * 24

PROFILES = ("hour", "weekday", "monthday")

# Canonical column names of the sample table.
SERVER = "server_name"
PROCESSOR = "processor"
TIME = "hr_time"
METRIC = "avg_processor_time"


# SQL text over the canonical columns.
CLIENT_SQL = f"substring({SERVER}, {CLIENT_POS}, {CLIENT_LEN})"
HOST_SQL = f"substring({SERVER}, {HOST_POS}, {HOST_LEN})"
TOTAL_SQL = f"contains({PROCESSOR}, '{TOTAL_MARK}')"
DATE_PART_SQL = {"hour": f"hour({TIME})", "weekday": f"dayofweek({TIME})", "monthday": f"dayofmonth({TIME})"}


def substrings_sql(s: str, k: int) -> str:
    """``substrings`` as SQL text."""
    return (
        f"CASE WHEN length({s}) >= {k} THEN transform(sequence(1, length({s}) - {k - 1}), i -> substring({s}, i, {k})) "
        f"WHEN {s} IS NOT NULL THEN CAST(array() AS ARRAY<STRING>) END"
    )


def percent_sql(part: str, whole: str) -> str:
    """``percent`` as SQL text."""
    return f"try_divide(100 * CAST({part} AS DOUBLE), CAST({whole} AS DOUBLE))"


def round_half_up_sql(x: str, digits: int = 1) -> str:
    """``round_half_up`` as SQL text."""
    return f"floor({x} * {10**digits} + 0.5D) / {10**digits}"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def client_key(name: str | Column = SERVER) -> Column:
    """Characters 1-3 of the server name (the original's substr(0, 3))."""
    return F.substring(col(name), CLIENT_POS, CLIENT_LEN)


def host_key(name: str | Column = SERVER) -> Column:
    """Character 5 of the server name; '' when the name is shorter."""
    return F.substring(col(name), HOST_POS, HOST_LEN)


def is_total(processor: str | Column = PROCESSOR) -> Column:
    """Substring test, as in the original (not equality)."""
    return col(processor).contains(TOTAL_MARK)


def date_part(part: str, ts: str | Column = TIME) -> Column:
    """hour of day (0-23), day of week (1 = Sunday) or day of month (1-31)."""
    c = col(ts)
    if part == "hour":
        return F.hour(c)
    if part == "weekday":
        return F.dayofweek(c)
    if part == "monthday":
        return F.dayofmonth(c)
    raise ValueError(f"unknown date part {part!r}; expected one of {PROFILES}")


def substrings(s: str | Column, k: int) -> Column:
    """All length-k substrings of ``s`` (empty array if shorter, null if null).

    ``contains(s, key)`` for a key of length k is exactly
    ``array_contains(substrings(s, k), key)``, which lets a containment test
    against a key table be planned as an equi-join instead of a nested loop.
    """
    if isinstance(s, str):
        return F.expr(substrings_sql(f"`{s}`", k))
    return F.when(
        F.length(s) >= k,
        F.transform(F.sequence(F.lit(1), F.length(s) - k + 1), lambda i: s.substr(i, F.lit(k))),
    ).when(s.isNotNull(), F.array().cast("array<string>"))


def as_double(c: str | Column) -> Column:
    return col(c).cast("double")


def percent(part: str | Column, whole: str | Column) -> Column:
    """100 * part / whole in double arithmetic; null when whole is 0 or null."""
    return F.try_divide(F.lit(100) * as_double(part), as_double(whole))


def round_half_up(x: str | Column, digits: int = 1) -> Column:
    """Half-up rounding done in plain double arithmetic (engine independent)."""
    scale = 10**digits
    return F.floor(col(x) * scale + F.lit(0.5)) / F.lit(scale)
