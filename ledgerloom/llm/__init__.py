"""Operators of a training-data pipeline, each one a Spark job.

Functions that run in tasks are sent along by value, so that executors need no
copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
