"""tidewheel: the data work behind running models in production, as Spark plans."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with them, so executors need no install of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
