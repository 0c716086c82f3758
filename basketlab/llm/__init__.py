"""Operators for preparing training text.  Nothing else in the library imports this subpackage.

Functions that run in tasks travel by value, so executors need the libraries but not
this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
