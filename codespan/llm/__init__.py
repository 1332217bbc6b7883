"""Operators of a training-data pipeline; nothing else in the library imports them.

Functions that run in Python workers travel by value, so executors need the
listed third-party packages but not this one.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
