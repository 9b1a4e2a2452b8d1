"""Tables as parquet snapshots under one root folder."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TABLES


def latest_snapshot(spark: SparkSession, root: str, name: str) -> int | None:
    """Number of the last complete snapshot of a table; None before the first."""
    try:
        return spark.read.schema("snapshot bigint").parquet(f"{root}/snapshots/{name}").agg(F.max("snapshot")).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_table(spark: SparkSession, root: str, name: str, snapshot: int | None = None) -> DataFrame:
    """The last snapshot of a table, or a given one; empty when there is none."""
    schema = TABLES[name]
    snapshot = latest_snapshot(spark, root, name) if snapshot is None else snapshot
    if snapshot is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/data/{name}/snapshot={snapshot}")


def write_table(df: DataFrame, root: str, name: str, snapshot: int | None = None) -> int:
    """Write a new snapshot and then announce it; readers keep the one they have.

    Writing the same snapshot number again replaces it.
    """
    spark = df.sparkSession
    if snapshot is None:
        last = latest_snapshot(spark, root, name)
        snapshot = 0 if last is None else last + 1
    fields = [F.col(f.name).cast(f.dataType) for f in TABLES[name].fields]
    df.select(*fields).write.mode("overwrite").parquet(f"{root}/data/{name}/snapshot={snapshot}")
    announce(spark, root, name, snapshot)
    return snapshot


def announce(spark: SparkSession, root: str, name: str, snapshot: int) -> None:
    """Record that a snapshot is complete."""
    marker = spark.range(1).select(F.lit(snapshot).cast("bigint").alias("snapshot")).coalesce(1)
    marker.write.mode("append").parquet(f"{root}/snapshots/{name}")


def append_records(df: DataFrame, root: str, name: str) -> None:
    """Append audit records."""
    df.write.mode("append").parquet(f"{root}/records/{name}")


def seed_lookup(existing: DataFrame, seed: DataFrame, key: str = "id") -> DataFrame:
    """Add seed rows whose key is not there yet."""
    return existing.unionByName(seed.join(existing.select(key), key, "left_anti"))
