"""Operators of a training-data pipeline over documents and embeddings.

Functions of this package go to the executors by value, so that a cluster
needs no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
