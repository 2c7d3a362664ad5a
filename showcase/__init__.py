"""Queries over the given tables that exercise every operator, each with its SQL twin."""

import sys

from pyspark import cloudpickle

# row functions defined here travel to the Python workers by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])
