"""Operators for preparing training text: quality, near-duplicates, decontamination, packing and the like."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with their code, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
