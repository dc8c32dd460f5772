"""Operators that prepare text for training, each with its query."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors with the tasks that use them, so
# that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
