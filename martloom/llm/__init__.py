"""Operators for preparing training text, each as a Spark job over whole tables."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to Python workers by value, so that executors need not have
# the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from martloom.llm.queries import ORACLES, QUERIES  # noqa: E402

__all__ = ["ORACLES", "QUERIES"]
