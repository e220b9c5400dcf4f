"""Operators for preparing training text: cleaning, near-duplicates, filters, mixing.

The package is shipped to executors by value, so a cluster needs no installation of
it beyond the libraries it imports.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
