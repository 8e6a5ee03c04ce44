"""Lineage analytics on Spark: trees, sequences on their nodes, and the data work around them."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
