"""Spark-native review analytics: pure DataFrame -> DataFrame operators."""

import sys

from pyspark import cloudpickle

# Executors get the code of Arrow functions by value, so a worker needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
