"""Record linkage on Spark: standardise, block, score and pair two tables that share no key."""

import sys

from pyspark import cloudpickle

# Arrow functions travel inside the task closure, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
