"""Operators for large training-data pipelines: dedup, filters, packing, extraction.

Nothing outside this subpackage imports it; ``queries`` holds the registered
queries and their SQL. Functions that run in Python workers travel with the
job, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
