"""Exact copies found by naming: equal blocks get equal integers, pairs of names get names, until a document is one name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteledger.operators import staged

BLOCK_BYTES = 8192


def normalised(text: Column) -> Column:
    """Text with each run of blanks as one space; null counts as empty."""
    # A lone space is left alone, so only runs and other blanks are rewritten.
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D](?:[\x20\x09-\x0D]++|(?<!\x20))", " ")


def _read(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    read = docs.select(F.col(f"`{id_col}`").alias("_doc"), normalised(F.col(f"`{text_col}`")).cast("binary").alias("_norm"))
    return read.withColumn("_sha", F.unhex(F.sha2("_norm", 256)))


def _blocks(read: DataFrame, block_bytes: int) -> DataFrame:
    """(_doc, _sha, blocks, i, _block): the text cut into blocks of fixed size; empty text is one empty block.

    There is always a block. An inner explode, like an equality that needs no
    null, would add a filter that computes the normalised text once more.
    """
    size = F.octet_length("_norm")
    count = F.greatest(F.ceil(size / block_bytes), F.lit(1)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring(F.col("_norm"), i * block_bytes + 1, F.lit(block_bytes)))
    return read.select("_doc", "_sha", count.alias("blocks"), cut.alias("_cut")).select("_doc", "_sha", "blocks", F.posexplode_outer("_cut").alias("i", "_block"))


def _same(left: DataFrame, right: DataFrame):
    return left["_doc"].eqNullSafe(right["_doc"]) & left["_sha"].eqNullSafe(right["_sha"])


def _whole(rows: DataFrame) -> DataFrame:
    """Documents all of whose parts are among the rows; one part without a counterpart makes a document unlike all others."""
    have = rows.groupBy("_doc", "_sha", "blocks").agg(F.count_distinct("i").alias("_have"))
    return have.where("_have = blocks").select("_doc", "_sha")


def _named(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with a shared key, which is replaced by its integer name.

    Keys are counted before they are shuffled, so one that a third of all rows
    share arrives once per task; repeated ones are sorted and numbered in that
    order. The join then splits what is skewed.
    """
    repeated = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    names = staged(repeated.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id()))
    return rows.join(names, keys).drop(*keys)


def identities(read: DataFrame, small: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(_doc, _sha, total, name) of documents that may have a copy: equal (total, name) means equal text, and unequal means unequal.

    Blocks are sorted into integer names by their bytes, so names agree only if
    blocks do. Adjacent names are then named as pairs, which halves the names of
    a document each round until one is left. Documents with a block or pair that
    occurs nowhere else leave at once. The hash in ``small`` does no more than
    keep blocks without any counterpart from being sorted.
    """
    # Staged, so that the join has plain shuffles on both sides and splits a hot block.
    twice = staged(small.groupBy("_h").agg(F.count("*").alias("_n")).where("_n > 1").select("_h"))
    whole = _whole(small.join(twice, "_h"))
    some = read.join(whole, _same(read, whole), "left_semi")
    rows = staged(_blocks(some, block_bytes))
    level = _named(rows, ["_block"]).distinct().withColumn("total", F.col("blocks"))
    done = []
    while True:
        level = staged(level)
        whole = _whole(level)
        level = level.join(whole, _same(level, whole), "left_semi")
        done.append(level.where("blocks = 1").select("_doc", "_sha", "total", "name"))
        if (level.agg(F.max("blocks")).first()[0] or 1) == 1:
            return reduce(DataFrame.unionByName, done)
        side = [F.max(F.when(F.col("i") % 2 == k, F.col("name"))) for k in (0, 1)]
        pairs = level.where("blocks > 1").groupBy("_doc", "_sha", "total", F.ceil(F.col("blocks") / 2).cast("int").alias("blocks"), F.expr("i div 2").alias("i"))
        level = _named(pairs.agg(side[0].alias("_a"), F.coalesce(side[1], F.lit(-1)).alias("_b")), ["_a", "_b"])


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every document with its class of equal texts.

    Result, one row per input row: id, keep_id (smallest id of the class),
    group_size, kept, text_sha256 (of the normalised text). Texts are equal when
    identical after each run of blanks became one space; null text is empty
    text. A null id is larger than all others. Of rows that repeat id and text
    one is kept. An empty table gives no rows; other columns are not read.
    """
    read = _read(docs, id_col, text_col)
    hashed = _blocks(read, block_bytes).withColumn("_h", F.xxhash64("_block")).drop("_block")
    small = staged(hashed)
    every = small.where("i = 0").groupBy("_doc", "_sha").agg(F.count("*").alias("_rows"))
    ids = identities(read, small, block_bytes)
    known = staged(every.join(ids, _same(every, ids), "left").select(every["_doc"], every["_sha"], "_rows", "total", "name"))
    shared = known.where("name IS NOT NULL")
    classes = staged(shared.groupBy("total", "name").agg(F.min("_doc").alias("keep_id"), F.sum("_rows").alias("group_size")))
    joined = shared.join(classes, ["total", "name"]).select("_doc", "_sha", "_rows", "keep_id", "group_size")
    alone = known.where("name IS NULL").select("_doc", "_sha", "_rows", F.col("_doc").alias("keep_id"), F.col("_rows").alias("group_size"))
    rows = joined.unionByName(alone).withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), "_rows")))
    kept = F.col("_doc").eqNullSafe(F.col("keep_id")) & (F.col("_k") == 1)
    return rows.select(F.col("_doc").alias(id_col), "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("_sha")).alias("text_sha256"))


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that ``exact_duplicates`` keeps, with their columns as they are."""
    kept = exact_duplicates(docs, id_col, text_col).where("kept").select(F.col(id_col).alias("_kept_id"), F.unhex("text_sha256").alias("_kept_sha"))
    sha = F.unhex(F.sha2(normalised(F.col(f"`{text_col}`")).cast("binary"), 256))
    packed = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(packed.alias("_doc"), F.col(f"`{id_col}`").alias("_id"), sha.alias("_sha"))
    found = keyed.join(kept, F.col("_id").eqNullSafe(F.col("_kept_id")) & F.col("_sha").eqNullSafe(F.col("_kept_sha")), "left_semi")
    first = F.row_number().over(Window.partitionBy("_id", "_sha").orderBy(F.lit(0)))
    return found.withColumn("_no", first).where("_no = 1").select("_doc.*")
