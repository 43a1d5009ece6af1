"""Operators for training data: scoring, tokens, archives, quality, mixing, duplicates.

Functions sent to executors travel with the job, so that executors need Spark, numpy,
pandas and the third-party libraries an operator names, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
