"""Analytics jobs written on Spark DataFrames, SQL and Spark ML."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with their task, so that executors
# need numpy and pyarrow but no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
