"""Keyed tables partitioned by a hash of the key, of which an upsert reads and replaces only the partitions that it touches."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sizing import staged
from .tables import announce, latest_snapshot

PARTS = 64


@dataclass(frozen=True)
class PartitionedTable:
    """A parquet table in folders ``_part=pmod(xxhash64(keys), n)``; n is fixed when the table is first written."""

    spark: SparkSession
    root: str
    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    parts: int = PARTS

    @property
    def path(self) -> str:
        return f"{self.root}/parts/{self.name}"

    def _number(self) -> int:
        known = latest_snapshot(self.spark, self.root, f"{self.name}.parts")
        if known is None:
            announce(self.spark, self.root, f"{self.name}.parts", self.parts)
        return self.parts if known is None else known

    def _part(self, n: int, names: Sequence[str]) -> Column:
        types = {f.name: f.dataType for f in self.schema}
        return F.pmod(F.xxhash64(*[F.col(c).cast(types[k]) for k, c in zip(self.keys, names, strict=True)]), F.lit(n)).cast("int")

    def _all(self) -> DataFrame:
        stored = T.StructType([*self.schema.fields, T.StructField("_part", T.IntegerType())])
        try:
            return self.spark.read.schema(stored).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], stored)

    def read(self) -> DataFrame:
        return self._all().drop("_part")

    def near(self, rows: DataFrame, *names: str) -> DataFrame:
        """The partitions that the keys of ``rows`` fall into; ``names`` are the columns that hold them.

        Their numbers are all that comes to the driver, and there are no more than partitions.
        """
        touched = rows.select(self._part(self._number(), names or self.keys).alias("_part")).distinct()
        return self._all().where(F.col("_part").isin([r["_part"] for r in touched.collect()])).drop("_part")

    def replace(self, rows: DataFrame) -> None:
        """Put ``rows`` in place of all partitions that they fall into.

        They are staged first, as they are mostly made from what they replace.
        """
        self.put(staged(rows))

    def put(self, rows: DataFrame) -> None:
        """``replace`` for rows that are not read from this table.

        Each partition is exchanged by Spark's dynamic partition overwrite, and a
        large one is written by several tasks. What broke off is run again.
        """
        fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]
        marked = rows.select(*fields).withColumn("_part", self._part(self._number(), self.keys)).hint("rebalance", F.col("_part"))
        marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_part").parquet(self.path)
