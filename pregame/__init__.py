"""Pre-game match features, models and as-of scoring on Spark."""
import sys

from pyspark import cloudpickle

# functions that Spark sends to its workers travel by value, so executors need
# no copy of this package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
