"""Operators for preparing training text; nothing else in the package imports this one.

Functions that run in Python workers are pickled by value, so executors need no copy of
this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
