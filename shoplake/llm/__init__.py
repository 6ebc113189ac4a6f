"""Operators that prepare training text: filters, deduplication, search, mixing, packing."""

import sys

from pyspark import cloudpickle

# What runs in tasks travels with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
