"""Operators for text corpora: quality, language, duplicates, secrets, sharding, packing."""

import sys

from pyspark import cloudpickle

# Functions travel to the tasks with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
