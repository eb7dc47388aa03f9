"""millrace: corpus preparation on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Python functions of this package travel to the executors by value, so a cluster
# needs no copy of the package on its workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
