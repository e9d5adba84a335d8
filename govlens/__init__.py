"""govlens: access-governance analytics on Spark DataFrames.

Every operator is a function ``DataFrame -> DataFrame`` (plus a spec); the
work runs as Spark jobs, and only small statistics (one value per column,
one row per class or cluster) ever reach the driver.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Spark's Python workers get this package's functions with the job, so they need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
