"""Operators for preparing training data. Nothing else in the library imports
this subpackage; its queries and SQL are in :mod:`tidelog.llm.queries`.

Functions of this subpackage that Spark sends to Python workers are pickled by
value, so executors need not have the library on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
