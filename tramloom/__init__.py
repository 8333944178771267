"""Transit schedule and delay analytics on Spark.

Everything here takes and returns DataFrames; nothing runs until the caller
asks for an action.  See README.md for the map of the package.
"""

import sys

from pyspark import cloudpickle

# The few Python functions that run inside tasks travel with their job, so workers
# do not need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
