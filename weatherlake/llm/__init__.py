"""Operators that prepare text for training language models.

Nothing else in the library imports this subpackage.  Functions that run inside tasks are
sent to the executors by value, so they need no copy of the package there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
