"""Operators of a pipeline that prepares training text, and the queries that apply them.

The task functions travel to the executors by value, so a cluster needs Spark, numpy,
pyarrow, xxhash, regex and tokenizers on its machines, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
