"""Shards that all have the mixture of the whole, by interleaving the strata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteledger.operators import staged
from siteledger.operators.sizing import broadcast_if_small

from .common import numbered


def interleave(
    docs: DataFrame, shards: int = 16, seed: str = "0", id_col: str = "doc_id", stratum: str = "source", text_col: str = "text"
) -> DataFrame:
    """Deal all documents into ``shards`` shards whose counts are at most one apart.

    Rows of a stratum are shuffled by a seeded hash of the id and ranked. Row r
    of n gets the fractional rank (r + 1/2) / n, all rows are sorted by it, and
    the sorted sequence is cut into even pieces, so a piece holds every stratum
    in proportion. Ranks come from range partitions, so no stratum sits in one task;
    counts per stratum are broadcast if a check of their size allows.

    Result: id, size (bytes + 1), text_crc32, stratum, shard, slot. A null text
    has no bytes, a null stratum is a stratum, null ids and repeated rows are
    dealt like others, an empty table gives no rows. Other columns are not read.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    small = staged(
        docs.select(
            F.col(f"`{id_col}`").alias("_id"),
            F.col(f"`{stratum}`").alias("_stratum"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
        ).withColumn("_mix", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))).cast("binary")))
    )
    ranked = numbered(small, ["_stratum", "_mix", "_id", "text_crc32"], "_rank")
    strata = ranked.groupBy(F.col("_stratum").alias("_s")).agg(F.count("*").alias("_n"), F.min("_rank").alias("_first"))
    part = ((F.col("_rank") - F.col("_first")) + F.lit(0.5)) / F.col("_n")
    even = ranked.join(broadcast_if_small(staged(strata)), F.col("_stratum").eqNullSafe(F.col("_s"))).withColumn("_part", part).drop("_rank", "_s", "_n", "_first")
    placed = numbered(even, ["_part", "_stratum", "_mix", "_id", "text_crc32"], "_rank")
    total = small.count()
    shard = F.expr(f"_rank * {shards}L div {max(total, 1)}").cast("int")
    first = F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).select(
        F.col("_id").alias(id_col), "size", "text_crc32", F.col("_stratum").alias(stratum), "shard", (F.col("_rank") - first).alias("slot")
    )
