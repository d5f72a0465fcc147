"""Operators that prepare training data for language models. Nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so only the driver needs it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
