"""Operators for building training data; each module is one operator and its registered query.

Functions that run in tasks are sent to them whole, so that executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
