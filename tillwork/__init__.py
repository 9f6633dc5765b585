"""Tillwork: retail and marketing analytics as Spark DataFrame operators.

Every public operator takes and returns Spark DataFrames, stays lazy wherever
the plan allows it, and keeps its work inside Spark SQL.  See README.md for the
map from operator families to modules.
"""

__version__ = "0.1.0"

import sys as _sys

from pyspark.cloudpickle import register_pickle_by_value as _by_value

# functions that run inside tasks travel with the job, so executors need no copy of this package
_by_value(_sys.modules[__name__])
