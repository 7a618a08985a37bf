"""Spark operators for analysing large collections of short social posts."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few functions that run in Python workers travel with the job, so workers
# need neither this package on their path nor the time to import it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
