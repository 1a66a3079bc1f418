"""Operators that prepare text corpora for training.

Nothing else in the library imports this package.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with them; executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
