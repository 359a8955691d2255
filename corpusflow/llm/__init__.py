"""Operators for building training data out of large text corpora. Nothing outside this folder imports it.

Functions of this folder that run in Python workers are sent by value, so that workers need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
