"""Scene-label, evaluation and retrieval operators as plain Spark DataFrame functions."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with them: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
