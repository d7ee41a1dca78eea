"""Analytic jobs on Spark DataFrames: text, social, movement, recommendation and time series.

Functions take and return DataFrames (or Columns) and stay lazy unless their docstring says that
they run a job.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with their helpers, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
