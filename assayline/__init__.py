"""Layered (bronze, silver, gold) data work on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions sent to tasks travel with their code, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
