"""Broadsheet: text analytics over document collections as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python tasks travel with their query: workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
