"""Keyed stream and table analytics on Spark."""

import sys

from pyspark import cloudpickle

# Steps and processors travel to the workers whole, so that executors need not
# have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
