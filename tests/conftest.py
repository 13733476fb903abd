import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from fleetlens.runtime import local_session

    s = local_session("*", shuffle_partitions=8, app="fleetlens-tests")
    yield s


def _ts(day, hour):
    return dt.datetime(2021, 8, day, hour, 0)


# Ten-row edge fixture (FIXTURES.md section 2).
EDGE_ROWS = [
    ("aig-A0", "_Total", _ts(1, 0), 10.0),
    ("aig-A0", "_Total", _ts(2, 0), 30.0),
    ("aig-BA", "_Total", _ts(1, 1), 5.0),
    ("aig-A0", "0", _ts(1, 0), 99.0),
    ("eti-C0", "_Total", _ts(1, 1), 7.0),
    ("zor-D0", "0", _ts(1, 1), 8.0),
    (None, "_Total", _ts(1, 2), 1.0),
    ("tuv", "_Total", _ts(1, 3), 2.0),
    ("eti-C0", "_Total", None, 4.0),
    ("eti-C0", "_Total", _ts(3, 5), None),
]


@pytest.fixture(scope="session")
def edge(spark):
    from fleetlens.sources.scan import CANONICAL_SCHEMA

    return spark.createDataFrame(EDGE_ROWS, CANONICAL_SCHEMA)


@pytest.fixture(scope="session")
def edge_model(edge):
    from fleetlens.plans.model import UsageModel

    return UsageModel(edge)


def rows(df, *cols):
    """Sorted tuples of the given columns (None sorts first)."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is not None, x) for x in t))
