"""Operators of a large-scale training-data pipeline, apart from the rest of the library."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
