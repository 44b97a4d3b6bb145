"""Operators for preparing training text at scale; nothing else in the library imports them.

Python functions of this package travel to the executors by value, so only its third-party
libraries have to be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
