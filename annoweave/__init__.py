"""Embedding-space annotation transfer and data preparation on Spark."""

import sys

from pyspark import cloudpickle

# Python operators travel with their code, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
