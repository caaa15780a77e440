"""Document vectors, clustering and method comparison as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Tasks receive the package's functions by value, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
