"""Spark-first engine for noisy, line-oriented scientific tables and their catalogue matches."""

import sys

from pyspark import cloudpickle

# Executors need not find this package on their path: its functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
