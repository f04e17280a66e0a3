"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage.

Functions that run in Python workers travel with their job, code included, so that executors
need not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
