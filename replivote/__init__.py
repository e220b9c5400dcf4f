"""Replicated annotation and answer consensus on Spark."""

from pyspark import cloudpickle

from replivote.functions import similarity
from replivote.sources import workbooks

# Task-side helpers travel with the functions that use them, so executors need no
# copy of this package.
cloudpickle.register_pickle_by_value(similarity)
cloudpickle.register_pickle_by_value(workbooks)
