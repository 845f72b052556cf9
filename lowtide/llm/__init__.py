"""Operators for training-data pipelines."""

import sys

from pyspark import cloudpickle

# functions sent to workers carry this package's code, so executors need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
