"""A matching engine on Spark.

Functions that run on executors are sent there by value, so workers need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
