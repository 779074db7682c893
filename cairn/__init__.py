"""DataFrame operators that take messy tables to linked, typed and scored results on Spark."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python functions travel to the executors by value, so only the driver needs this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
