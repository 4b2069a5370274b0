"""Operators for preparing training data; nothing else in the package imports this one.

Functions of these modules travel to Python workers by value, so a cluster
needs no copy of the package on its executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
