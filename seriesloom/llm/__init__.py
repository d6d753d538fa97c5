"""Operators for preparing training text: deduplication, scoring, extraction, tokenizing, sharding, packing.

Nothing else in the library imports this package. Functions that run on executors are shipped by value, so
workers need the third-party libraries but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
