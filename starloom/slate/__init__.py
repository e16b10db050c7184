"""Registered queries: Spark form and, where SQL can say it, the same in SQL."""

import importlib

QUERIES = {}
ORACLES = {}

_MODULES = ("sales", "cubes", "rental", "activity", "music", "texts", "loads", "bikes", "immigration", "checks", "stored", "chains")


def query(sql=None):
    """Register a ``(spark, folder) -> DataFrame`` function under its name."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def load_all():
    for module in _MODULES:
        importlib.import_module(f"{__name__}.{module}")
    return QUERIES, ORACLES
