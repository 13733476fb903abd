"""Independent SQL for every registered query, for DuckDB over the same
Parquet tables (views ``events`` etc. registered by the caller).

It follows the original semantics literally - ``contains`` join conditions,
row-level sums - so it checks the Spark plans (substring equi-joins over
per-server partial sums) against a brute-force formulation.
"""

from __future__ import annotations

# Sample table from ``events`` (same rules as fleetlens.sources.scan._events).
SAMPLES = """samples AS (
  SELECT server_name, CASE WHEN event_id % 4 = 0 OR coalesce(server_name = 'zor-Z0', false) THEN '0' ELSE '_Total' END AS processor, hr_time, avg_processor_time
  FROM (
    SELECT event_id,
           CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 47 = 0 THEN substr(event_type, 1, 3) WHEN event_id % 41 = 0 THEN 'zor-Z0'
                ELSE concat(substr(event_type, 1, 3), '-', chr(CAST(65 + user_id % 10 AS INTEGER)),
                            CASE WHEN user_id % 7 = 0 THEN chr(CAST(65 + user_id % 3 AS INTEGER)) ELSE '0' END,
                            CASE WHEN user_id % 11 <> 0 THEN '' WHEN substr(event_type, 1, 3) = 'pur' THEN 'vie' ELSE 'pur' END) END AS server_name,
           CASE WHEN event_id % 37 <> 0 THEN ts END AS hr_time,
           CASE WHEN event_id % 31 <> 0 THEN CAST(value AS DECIMAL(18,2)) END AS avg_processor_time
    FROM events) e)"""
TOT = "tot AS (SELECT * FROM samples WHERE contains(processor, '_Total') AND server_name IS NOT NULL)"
CLIENTS = """clients AS (SELECT DISTINCT substr(server_name, 1, 3) AS client FROM samples
  WHERE server_name IS NOT NULL AND substr(server_name, 1, 3) <> '')"""
CM = "cm AS (SELECT c.client, t.* FROM tot t JOIN clients c ON contains(t.server_name, c.client))"
HOSTS = """hosts AS (SELECT DISTINCT client, substr(server_name, 5, 1) AS host FROM cm
  WHERE substr(server_name, 5, 1) <> '')"""
HM = "hm AS (SELECT h.host, r.* FROM cm r JOIN hosts h ON r.client = h.client AND contains(r.server_name, h.host))"
MEMBERS = (SAMPLES, TOT, CLIENTS, CM, HOSTS, HM)

PART_SQL = {
    "hour": "CAST(hour(hr_time) AS INTEGER)",
    "weekday": "CAST(dayofweek(hr_time) + 1 AS INTEGER)",
    "monthday": "CAST(dayofmonth(hr_time) AS INTEGER)",
}
DIVISOR = {"hour": 31, "weekday": 96, "monthday": 24}

HOST_TOTALS = "ht AS (SELECT client, host, sum(avg_processor_time) AS total FROM hm GROUP BY client, host)"
CLIENT_TOTALS = """ct AS (SELECT c.client, s.total FROM clients c LEFT JOIN
  (SELECT client, sum(avg_processor_time) AS total FROM cm GROUP BY client) s ON c.client = s.client)"""
HOST_SHARE = """hs AS (SELECT client, host, CAST(total AS DOUBLE) AS total,
  100 * CAST(total AS DOUBLE) / NULLIF(CAST(sum(total) OVER (PARTITION BY client) AS DOUBLE), 0) AS pct FROM ht)"""
CLIENT_SHARE = """cs AS (SELECT client, CAST(total AS DOUBLE) AS total,
  100 * CAST(total AS DOUBLE) / NULLIF(CAST((SELECT sum(total) FROM ct) AS DOUBLE), 0) AS pct FROM ct)"""


def _with(ctes, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _profile(part: str, keys: str, src: str) -> str:
    p = PART_SQL[part]
    return _with(
        MEMBERS,
        f"""SELECT {keys}, {part}, CAST(total AS DOUBLE) AS total, CAST(total AS DOUBLE) / {DIVISOR[part]} AS value
FROM (SELECT {keys}, {p} AS {part}, sum(avg_processor_time) AS total FROM {src}
      WHERE hr_time IS NOT NULL GROUP BY {keys}, {p}) x""",
    )


def _round1(x: str) -> str:
    return f"floor({x} * 10 + 0.5) / 10"


def _report_body() -> str:
    profs = " UNION ALL ".join(
        f"SELECT client, host, '{p}' AS profile, CAST({PART_SQL[p]} AS DOUBLE) AS bucket, sum(avg_processor_time) AS total "
        f"FROM hm WHERE hr_time IS NOT NULL GROUP BY client, host, {PART_SQL[p]}"
        for p in DIVISOR
    )
    return f"""SELECT client, host, profile, bucket, CAST(total AS DOUBLE) AS total,
       CAST(total AS DOUBLE) / CASE profile WHEN 'hour' THEN 31 WHEN 'weekday' THEN 96 ELSE 24 END AS value, CAST(NULL AS DOUBLE) AS value_1dp
FROM ({profs}) p
UNION ALL
SELECT client, host, 'share' AS profile, CAST(NULL AS DOUBLE) AS bucket, total, pct AS value, {_round1('pct')} AS value_1dp FROM hs
UNION ALL
SELECT client, host, 'month_avg' AS profile, CAST(NULL AS DOUBLE) AS bucket, total, total / 744 AS value, CAST(NULL AS DOUBLE) AS value_1dp FROM hs
UNION ALL
SELECT client, host, 'week_avg' AS profile, CAST(NULL AS DOUBLE) AS bucket, total, total / 672 AS value, CAST(NULL AS DOUBLE) AS value_1dp FROM hs"""


SAMPLE_COLS = "server_name, processor, hr_time, CAST(avg_processor_time AS DOUBLE) AS avg_processor_time"


def oracle_sql() -> dict[str, str]:
    s = (SAMPLES,)
    report = _report_body()
    fleet = (
        report
        + "\nUNION ALL\nSELECT client, CAST(NULL AS VARCHAR) AS host, 'client_share' AS profile, "
        + f"CAST(NULL AS DOUBLE) AS bucket, total, pct AS value, {_round1('pct')} AS value_1dp FROM cs"
    )
    share_ctes = (*MEMBERS, HOST_TOTALS, HOST_SHARE)
    fleet_ctes = (*share_ctes, CLIENT_TOTALS, CLIENT_SHARE)
    out = {
        "scan_metrics": _with(s, f"SELECT {SAMPLE_COLS} FROM samples"),
        "ingest_roundtrip": _with(s, f"SELECT {SAMPLE_COLS} FROM samples"),
        "sql_select_all": _with(s, f"SELECT {SAMPLE_COLS} FROM samples"),
        "cached_table_scan": _with(
            s, "SELECT server_name, hr_time, CAST(avg_processor_time AS DOUBLE) AS avg_processor_time FROM samples WHERE contains(processor, '_Total')"
        ),
        "report_sink_roundtrip": _with(fleet_ctes, fleet),
        "filter_total": _with(s, f"SELECT {SAMPLE_COLS} FROM samples WHERE contains(processor, '_Total')"),
        "filter_client_total": _with(
            s, f"SELECT {SAMPLE_COLS} FROM samples WHERE contains(server_name, 'pur') AND contains(processor, '_Total')"
        ),
        "filter_client_host": _with(
            s,
            f"SELECT {SAMPLE_COLS} FROM samples WHERE contains(server_name, 'pur') AND contains(processor, '_Total') "
            "AND contains(server_name, 'A')",
        ),
        "filter_datepart_eq": _with(s, f"SELECT {SAMPLE_COLS} FROM samples WHERE hour(hr_time) = 13"),
        "project_dateparts": _with(
            s,
            f"SELECT server_name, hr_time, {PART_SQL['hour']} AS hour, {PART_SQL['weekday']} AS weekday, "
            f"{PART_SQL['monthday']} AS monthday FROM samples",
        ),
        "derive_keys": _with(
            s,
            f"SELECT {SAMPLE_COLS}, substr(server_name, 1, 3) AS client, substr(server_name, 5, 1) AS host FROM samples",
        ),
        "client_membership": _with(MEMBERS, f"SELECT client, {SAMPLE_COLS} FROM cm"),
        "host_membership": _with(MEMBERS, f"SELECT client, host, {SAMPLE_COLS} FROM hm"),
        "total_usage": _with(s, "SELECT CAST(sum(avg_processor_time) AS DOUBLE) AS total FROM samples WHERE contains(processor, '_Total')"),
        "total_usage_projected": _with(
            s, "SELECT CAST(sum(avg_processor_time) AS DOUBLE) AS total FROM samples WHERE contains(processor, '_Total')"
        ),
        "distinct_clients": _with((SAMPLES, CLIENTS), "SELECT client FROM clients ORDER BY client"),
        "distinct_hosts": _with(MEMBERS, "SELECT client, host FROM hosts ORDER BY client, host"),
        "hourly_profile_client": _profile("hour", "client", "cm"),
        "hourly_profile_host": _profile("hour", "client, host", "hm"),
        "weekly_profile_host": _profile("weekday", "client, host", "hm"),
        "monthly_profile_host": _profile("monthday", "client, host", "hm"),
        "host_totals": _with((*MEMBERS, HOST_TOTALS), "SELECT client, host, CAST(total AS DOUBLE) AS total FROM ht"),
        "client_totals": _with((SAMPLES, TOT, CLIENTS, CM, CLIENT_TOTALS), "SELECT client, CAST(total AS DOUBLE) AS total FROM ct"),
        "usage_averages": _with(
            (*MEMBERS, HOST_TOTALS),
            "SELECT client, host, CAST(total AS DOUBLE) AS total, CAST(total AS DOUBLE) / 744 AS month_avg, "
            "CAST(total AS DOUBLE) / 672 AS week_avg FROM ht",
        ),
        "host_share": _with(share_ctes, f"SELECT client, host, total, pct, {_round1('pct')} AS pct_1dp FROM hs"),
        "client_share": _with(
            (SAMPLES, TOT, CLIENTS, CM, CLIENT_TOTALS, CLIENT_SHARE),
            f"SELECT client, total, pct, {_round1('pct')} AS pct_1dp FROM cs",
        ),
        "client_report": _with(share_ctes, report),
        "fleet_report": _with(fleet_ctes, fleet),
    }
    for part, name in (("hour", "distinct_hours"), ("weekday", "distinct_weekdays"), ("monthday", "distinct_monthdays")):
        out[name] = _with(
            s,
            f"SELECT DISTINCT {PART_SQL[part]} AS {part} FROM samples "
            f"WHERE contains(processor, '_Total') AND hr_time IS NOT NULL ORDER BY 1",
        )
    return out
