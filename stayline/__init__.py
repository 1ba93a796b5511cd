"""Client-retention analytics on Spark DataFrames.

Functions of this package that run inside Python workers are pickled by value,
so executors need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
