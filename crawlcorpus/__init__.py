"""Web-archive crawls to text corpora, as Spark jobs."""

import sys

from pyspark import cloudpickle

# Python code that runs in tasks travels with the job, so that executors need neither
# this package installed nor a file shipped to each of them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
