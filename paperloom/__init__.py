"""Spark-native analytics over corpora of semi-structured documents."""

import sys

from pyspark import cloudpickle

# Functions that run on executors carry this package's code with them: nothing needs to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
