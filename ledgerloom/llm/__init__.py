"""Operators for training-data pipelines: mixing, formatting, counting, deduplication, filtering and extraction."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the executors with the job, which need not have it installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
