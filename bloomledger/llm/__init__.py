"""Operators for preparing training text at scale; nothing outside this folder imports them.

Their functions travel to the executors by value, so executors need no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
