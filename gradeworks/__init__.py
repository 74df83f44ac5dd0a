"""Preparation, profiling and grading of large labelled tables on Spark."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with them, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
