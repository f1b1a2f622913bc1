"""Operators for large-scale training-data preparation.

Nothing outside this subpackage imports it. Every operator is a function from DataFrames to
DataFrames on the caller's session; ``queries`` registers one query per operator.
"""

import sys

from pyspark import cloudpickle

# functions that run in Python workers travel with the task; executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
