"""Operators and the corpus pipeline of a large-scale training-data preparation.

Nothing else in the library imports this package. Its functions travel to the executors by value, so
that a cluster needs no copy of the package on the workers' path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
