"""Operators of a training-data pipeline over document and vector tables.

Nothing else in the library imports this subpackage. Functions that run in
Spark's Python workers are pickled by value, so a cluster needs no copy of the
package on its executors (only pyarrow, numpy, regex and xxhash).
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
