"""Operators for preparing training data, each with its query in ``queries``."""

import sys

from pyspark import cloudpickle

# Functions travel to the workers by value, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
