"""leafmill: document ingestion and retrieval as Spark DataFrame transformations."""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
