"""Sheet-shaped and parameter-table analytics expressed as Spark jobs."""

import sys

from pyspark import cloudpickle

# Python helpers travel to the executors with the functions that use them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
