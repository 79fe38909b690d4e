"""Operators of a training-data pipeline; nothing else in the library imports this package.

Functions that run in Python workers travel by value, so executors need only the public libraries.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
