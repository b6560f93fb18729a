"""vaultrail: sealed, searchable audit ledgers as Spark DataFrame and Structured Streaming jobs."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to Python workers with the job, so executors need no installation of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
