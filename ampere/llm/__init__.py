"""Operators for building training data at corpus scale.

Each module holds one operator with a general interface; ``queries`` holds the thin
registered queries. Functions that run inside Python workers are shipped by value, so
executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
