"""rosterweave: a Spark-native engine for integrating records about people."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions of this package travel to the executors by value, so that they need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
