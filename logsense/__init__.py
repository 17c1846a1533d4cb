"""logsense: log templates and anomalies as PySpark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so a cluster needs no --py-files.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
