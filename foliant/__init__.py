"""Foliant: a Spark-native engine for catalogue data and text corpora."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run on executors are shipped by value, so a cluster needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
