"""Operators for preparing training data: packing, deduplication, archives, vectors, quality.

Nothing else in the library imports this subpackage. Functions that run in Python tasks travel to
the executors whole, so the package need not be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
