"""Spark-native analytics over nested records: flattening, typing, graphs and data checks."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# functions sent to Python workers travel with their code, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
