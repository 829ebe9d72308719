"""Operators for training data: dedup, quality, decontamination, packing and others."""

import sys

from pyspark import cloudpickle

# tasks get these functions by value, so that executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
