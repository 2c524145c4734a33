"""Training-data operators: ten Spark jobs over documents and web pages.

Functions that run inside Python workers are shipped by value, so executors do
not need this repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
