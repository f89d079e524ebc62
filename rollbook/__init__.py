"""rollbook: Spark jobs for a continuously re-crawled directory of classes and people."""

import sys

from pyspark import cloudpickle

# Python workers get the small UDF helpers inside the task, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
