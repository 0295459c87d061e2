"""Operators of a training-data pipeline; nothing else in the library imports them.

The package's functions travel to the executors by value, so a cluster needs no copy of it
on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
