"""lagline: late-delivery analytics on Spark DataFrames and pyspark.ml."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
