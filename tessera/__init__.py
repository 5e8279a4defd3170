"""Spark-first record linkage and data-processing operators.

The package ships its own functions to Python workers by value, so executors
need no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
