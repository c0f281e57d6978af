"""Operators for preparing training data; nothing else in the library imports them.

Their task-side functions are sent to executors by value, so that a cluster needs no
installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
