"""Training-data operators: deduplication, tokenising, extraction, mixing, formatting, search, toxicity."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the tasks by value: executors need no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
