"""Operators for preparing training text; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with the job: executors need no copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])
