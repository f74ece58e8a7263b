"""Training-data operators over documents and pages; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the job, so that it
# need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
