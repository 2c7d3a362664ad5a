"""Analytics models and per-row Python work as Spark jobs."""

import sys

from pyspark import cloudpickle

# Python workers then need no installed copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
