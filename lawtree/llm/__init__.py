"""Operators for preparing language-model training data."""

import sys

from pyspark import cloudpickle

# Executors get these functions by value and need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
