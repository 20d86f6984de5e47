"""Operators that prepare training data; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so no file has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
