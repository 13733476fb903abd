"""Print the executed (AQE-final) physical plan of registered queries.

Usage: python tools/show_plans.py [sf_dir] name [name ...]
Each query is collected first, so the plan shown is the one that ran.
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    from fleetlens.plans.registry import QUERIES
    from fleetlens.runtime import local_session

    spark = local_session(8, 16, app="show-plans")
    for name in args:
        df = QUERIES[name](spark, sf_dir)
        df.collect()
        print(f"===== {name}")
        df.explain()


if __name__ == "__main__":
    main()
