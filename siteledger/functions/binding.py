"""Compute a value once and use it several times inside one expression."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row.

    A Column used twice is computed twice wherever common subexpressions are
    not shared, above all inside lambdas.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_list(values: Sequence[str]) -> Column:
    """An array of constant strings as one literal, folded by the optimizer."""
    if any("\n" in value for value in values):
        return F.array(*[F.lit(value) for value in values])
    return F.split(F.lit("\n".join(values)), "\n")
