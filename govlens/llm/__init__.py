"""Operators for preparing large text corpora; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Spark's Python workers get this package's functions with the job, so they need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
