"""Spark-native analytics for incident records, event feeds and text corpora."""

import sys

from pyspark import cloudpickle

# Executors need not have this package installed: what tasks run travels with them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
