"""Operators of a training-data pipeline over documents and pages."""

import sys

from pyspark import cloudpickle

# Functions for Python workers travel with the job; executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
