"""Spark-native engine for bilingual long-form text: chunks, glossaries, keyed merges and metadata tables."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Python functions travel to the executors whole, so the package need not be installed there.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
