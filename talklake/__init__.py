"""talklake: build and search a corpus of timed transcripts with Spark."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run on workers travel with their code, so that executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
