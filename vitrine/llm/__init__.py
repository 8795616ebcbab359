"""Operators for building and cleaning training corpora; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Executors need not have the library installed: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
