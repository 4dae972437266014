"""Operators of a training-data pipeline over document tables.

Self-contained: nothing else in the library imports this subpackage.  The
queries and their SQL are in :mod:`veilspark.llm.queries`.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so they run there
# also when the package itself was not shipped with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
