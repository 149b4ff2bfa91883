"""threadloom: conversational-text analytics on Spark DataFrames.

Functions that run inside Python workers are shipped by value, so executors do
not need this package installed next to them.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
