"""Operators for preparing training data. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so a cluster
# needs no copy of it there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
