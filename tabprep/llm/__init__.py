"""Operators for preparing training text. Their functions travel to Python workers by value, so a cluster need not
have this package installed."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
