"""Review insights as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

from reviewloom.params import Params

# functions travel to Python workers by value: executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Params"]
