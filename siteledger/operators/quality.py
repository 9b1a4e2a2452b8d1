"""Checks of the constraints the table schemas declare."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their count; NULL keys never clash."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.where(present).groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def fk_orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose foreign key is set but missing in the parent."""
    keys = parent.select(F.col(pk).alias("_pk"))
    return child.where(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_pk"), "left_anti")


def length_violations(df: DataFrame, limits: Mapping[str, int], key: str = "id") -> DataFrame:
    """(key, column_name, length, max_length) of every string longer than declared."""
    checks = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.length(c).alias("length"), F.lit(n).alias("max_length"))
            for c, n in limits.items()
        ]
    )
    too_long = F.filter(checks, lambda x: x["length"] > x["max_length"])
    return df.select(key, F.explode(too_long).alias("v")).select(key, "v.column_name", "v.length", "v.max_length")


def null_violations(df: DataFrame, columns: Sequence[str], key: str = "id") -> DataFrame:
    """(key, column_name) of every NULL in a column declared NOT NULL."""
    missing = F.filter(
        F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]), lambda x: x.isNotNull()
    )
    return df.select(key, F.explode(missing).alias("column_name"))
