"""Operators that prepare training text: one module each, DataFrames in and out.

Nothing else in the library imports this package. Its functions travel to the executors by
value, so they need no copy of it there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
