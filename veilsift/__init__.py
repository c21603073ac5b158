"""Find, curate and score personal data in text with Spark.

The package's functions travel to the executors by value, so only the driver needs it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
