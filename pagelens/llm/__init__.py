"""Operators of a training-data pipeline; nothing else in the package imports this folder.

Python functions of this folder travel to the executors by value, so that a cluster needs no copy of the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
