"""Anomaly analytics on PySpark: flow-log outliers and payment fraud.

Every operator takes and returns DataFrames, starts no action of its own unless
its docstring says so, and serves batch and Structured Streaming alike.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python functions of this package travel to the workers by value, so executors
# need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
