"""Consensus ranking and screening analytics as PySpark DataFrame jobs."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Python helpers travel with the job, so executors need not have the package.
register_pickle_by_value(sys.modules[__name__])
