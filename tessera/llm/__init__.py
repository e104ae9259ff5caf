"""Operators of a training-data pipeline, one module each, and their queries."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so that a
# cluster needs no copy of the library on its machines.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from tessera.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402

__all__ = ["ORACLE_SQL", "QUERIES"]
