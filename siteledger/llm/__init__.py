"""Operators for training-data corpora, their queries and the SQL that must agree."""

import sys

from pyspark import cloudpickle

# Tasks get these functions with their code, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from .queries import ORACLE, QUERIES  # noqa: E402

__all__ = ["ORACLE", "QUERIES"]
