"""Operators for preparing training data.

Functions of this package run in Python workers. They are sent by value, so a job needs no
copy of the package on the executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
