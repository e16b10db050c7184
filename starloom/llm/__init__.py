"""Operators for training-data pipelines, and their registered queries."""

import importlib
import sys

from pyspark import cloudpickle

# Functions of this package travel with the tasks; executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUERIES = {}
ORACLES = {}


def query(sql=None):
    """Register a ``(spark, folder) -> DataFrame`` function under its name."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def load_all():
    importlib.import_module(f"{__name__}.queries")
    return QUERIES, ORACLES
