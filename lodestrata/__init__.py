"""Lakehouse analytics on PySpark: object queries, metrics, ingestion, modelling, quality and governance."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors by value, so that these need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
