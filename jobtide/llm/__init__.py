"""Operators for preparing training data from a text corpus."""

import sys

from pyspark import cloudpickle

# Python tasks carry the package's functions with them, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
