"""Operators of a training-data pipeline over ``documents``-like tables.

Nothing else in the library imports this subpackage.  Each operator module
has a general function (DataFrame in, DataFrame out) and ``registry`` holds
the thin queries ``opN_<name>`` that derive digest columns from it.
"""

import sys

from pyspark import cloudpickle

# Task code travels with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
