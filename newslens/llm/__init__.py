"""Operators of a training-data pipeline, one module each; nothing else in the library imports them.

Their task functions travel to the executors by value, so the package need not
be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
