"""Quayside: DataFrame operators that land, conform, load, publish and report on tables."""

import sys

from pyspark import cloudpickle

# Executors need not have the package installed: the few functions that run in Python tasks are
# sent to them whole instead of by name.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
