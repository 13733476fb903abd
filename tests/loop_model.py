"""Plain-Python statement of the original per-group loops, for equivalence
tests: client keys from all rows, membership by substring, sums per bucket
divided by fixed constants, shares over the sum of host totals."""

from __future__ import annotations

from collections import defaultdict

DIV = {"hour": 31, "weekday": 96, "monthday": 24}


def _part(ts, part):
    if ts is None:
        return None
    if part == "hour":
        return ts.hour
    if part == "weekday":
        return (ts.isoweekday() % 7) + 1  # Sunday = 1
    return ts.day


def _sum(vals):
    vals = [v for v in vals if v is not None]
    return sum(vals) if vals else None


def clients(rows):
    return sorted({r[0][:3] for r in rows if r[0] is not None and r[0][:3] != ""})


def client_rows(rows, client):
    return [r for r in rows if r[0] is not None and r[1] is not None and client in r[0] and "_Total" in r[1]]


def hosts(crow):
    return sorted({r[0][4:5] for r in crow if r[0][4:5] != ""})


def host_rows(crow, host):
    return [r for r in crow if host in r[0]]


def profile(rows, part):
    """{bucket: (total, total / divisor)} over buckets present, nulls skipped."""
    buckets = defaultdict(list)
    for r in rows:
        b = _part(r[2], part)
        if b is not None:
            buckets[b].append(r[3])
    out = {}
    for b, vals in buckets.items():
        t = _sum(vals)
        out[b] = (t, None if t is None else t / DIV[part])
    return out


def fleet(rows):
    """Everything the reports hold, keyed for comparison."""
    res = {"host_profile": {}, "host_total": {}, "client_total": {}, "client_profile": {}}
    for c in clients(rows):
        crow = client_rows(rows, c)
        res["client_total"][c] = _sum([r[3] for r in crow])
        for b, v in profile(crow, "hour").items():
            res["client_profile"][(c, b)] = v
        for h in hosts(crow):
            hrow = host_rows(crow, h)
            res["host_total"][(c, h)] = _sum([r[3] for r in hrow])
            for part in DIV:
                for b, v in profile(hrow, part).items():
                    res["host_profile"][(c, h, part, b)] = v
    return res
