"""Operators and queries of a training-data pipeline. Nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# Functions of this folder travel to executors by value, so that those need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
