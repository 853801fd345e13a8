"""folioscan: turns an archive of raw web pages into a queryable catalogue, on Spark."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python tasks travel with the task, so executors need no copy of this
# package and a session can be started from any folder.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
