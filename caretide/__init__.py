"""caretide: health-service demand analytics on Spark DataFrames.

Every public operator takes and returns Spark DataFrames (or Columns), so it
composes with ``df.transform`` and plain Spark code.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in Python workers travel with their tasks, so executors do
# not need the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
