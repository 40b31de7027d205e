"""Spark-native data side of a machine-learning platform.

Sources bring rows into one raw envelope, operators clean, featurise, split, compare, rank and gate
them, plans string operators into whole jobs, and streaming holds the Structured Streaming forms.
"""

import sys

from pyspark import cloudpickle

from sluiceway.session import build_session, scratch_path, to_scratch_table

# The few Python functions that run in tasks travel with the job; executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "scratch_path", "to_scratch_table"]
