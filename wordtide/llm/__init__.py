"""Operators of a training-data pipeline: deduplication, counts, scans, scores and mixing."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with all they need of this package, so nothing has to be
# installed on executors.
cloudpickle.register_pickle_by_value(sys.modules["wordtide"])
