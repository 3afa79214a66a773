"""Trip analytics as composable Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Tasks carry the package's functions with them, so that executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
