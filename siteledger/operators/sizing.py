"""Size checks before a side is broadcast, and staged intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether a lookup is small; reads at most ``max_rows`` + 1 of its rows."""
    size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    rows, total = df.limit(max_rows + 1).select(size.alias("n")).agg(F.count("*"), F.sum("n")).first()
    return rows <= max_rows and (total or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, **limits) -> DataFrame:
    """Broadcast hint for a side of checked size.

    A larger side comes back unhinted: the join then sorts and merges, and
    adaptive execution splits its skewed partitions.
    """
    return F.broadcast(df) if fits_broadcast(df, **limits) else df


def shared_dir(spark: SparkSession) -> str:
    """Folder for staged tables: what the cluster names in spark.checkpoint.dir,
    or a folder of the warehouse, which executors share as well, if that is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"


def staged(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost
    executors, and later readers prune columns."""
    path = f"{shared_dir(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _staged_paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Folders written by this process, for ``clear_staged``.
_staged_paths: list[str] = []


def clear_staged(spark: SparkSession) -> int:
    """Delete the folders this process staged; returns their number.

    Call it once the results of a job are written: they are read from there.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf, paths = spark.sparkContext._jsc.hadoopConfiguration(), _staged_paths[:]
    for name in paths:
        path = hadoop.Path(name)
        path.getFileSystem(conf).delete(path, True)
        _staged_paths.remove(name)
    return len(paths)
