"""Operators of a training-data pipeline: near-dedup, sharding, tokenising, licences, leaks, PII, toxicity.

Nothing else in the library imports this subpackage.  The functions that run
inside Spark tasks travel with their tasks (pickled by value), so executors
need the installed third-party libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
