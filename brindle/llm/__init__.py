"""Operators of a training-data pipeline.

Each module holds one operator.  ``queries`` registers a query for each, and
``corpus_pipeline`` at the repository top chains five of them.

Functions that run inside tasks travel by value, so executors need Spark and the
installed libraries, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
