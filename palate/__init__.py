"""Recommendation analytics on Spark: operators over rating tables, factor tables and feedback streams.

Every operator takes and returns DataFrames and serves a *batch* of users or seed
sets.  The session belongs to the caller; nothing here starts or stops one.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few functions that run in Python workers travel by value: executors need no copy of this
# package and the driver may be started from any folder.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
