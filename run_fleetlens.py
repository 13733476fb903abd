"""Launcher for spark-submit (which runs a file, not a module):

    spark-submit run_fleetlens.py report --input /data/cpu_samples --output /data/reports/2021-08

Only the driver imports fleetlens (the plans contain no Python UDFs), so no
--py-files is needed.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fleetlens.__main__ import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(main())
