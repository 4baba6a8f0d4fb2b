"""Training-data operators: scoring, quality, personal data, archives, extraction, packing,
near duplicates, search and mixing.  Nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# tasks get these functions with the job, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
