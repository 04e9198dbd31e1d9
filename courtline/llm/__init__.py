"""Operators for training-data pipelines over documents, pages and conversations.

Functions of this package go to the executors by value, so no executor needs the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
