"""Operators of a training-data pipeline: deduplication, filters, mixing, tokens.

One module per operator with a general interface over DataFrames; ``queries`` holds
the thin registered queries and their SQL.  Nothing outside this package imports it
except the entry module, which does so behind a guard.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
