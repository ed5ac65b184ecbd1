"""Operators for training-data preparation; nothing else in the library imports this package.

Functions of this package travel to the executors by value, so that only the driver needs it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
