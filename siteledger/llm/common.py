"""Helpers of the corpus operators: dense ranks, batches, hashes, folds."""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siteledger.operators import staged

CHUNK = 1 << 20
BASE, OTHER_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
# Blanks that part words: space and 9 to 13. Letters A to Z in lower case.
_BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint8)

FILTER_BITS = 26


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def numbered(df: DataFrame, order: Sequence[str], name: str = "rank") -> DataFrame:
    """Dense 0-based rank of every row in the given order.

    Rows are range-partitioned, sorted and staged, so counting and numbering
    see the same partitions. Only one count per partition is broadcast. Give
    narrow rows, and an order that tells rows apart, else a run of equal rows
    shares one partition.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stable = staged(ranged.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).alias("_part")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = stable.groupBy(part).agg(F.count("*").alias("_n"))
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.col("_at") - F.shiftleft("_part", 33) + F.col("_before")
    joined = stable.withColumn("_part", F.shiftright("_at", 33)).join(F.broadcast(offsets), "_part")
    return joined.select(*df.columns, place.alias(name))


def release(spark: SparkSession) -> None:
    """Let go of shuffle files that nothing refers to any more; Spark drops them when the driver collects its garbage.

    The last job is still referred to for a moment, so it takes two rounds.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def unstage(df: DataFrame) -> None:
    """Delete the folder of a staged table that nothing reads any more."""
    spark = df.sparkSession
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash per word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash per window of ``k`` consecutive word hashes; with fewer
    words, one for the whole sequence; none without words."""
    if not len(hashes):
        return hashes
    k = min(k, len(hashes))
    n = len(hashes) - k + 1
    out = hashes[:n] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k)
    for i in range(1, k):
        out ^= out >> np.uint64(29)
        out = (out * np.uint64(0xBF58476D1CE4E5B9) + hashes[i : i + n]) * np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(31))


def spans(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return edges[::2], edges[1::2]


def batches(columns: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def rows_of(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """Values of the named columns, row by row."""
    return zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names), strict=True)


def with_text(docs: DataFrame, keep: Sequence[str], text_col: str) -> DataFrame:
    """Columns to keep as struct ``_doc``, and the text as ``_text`` if it is not among them."""
    packed = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_doc")
    return docs.select(packed, *([] if text_col in keep else [F.col(f"`{text_col}`").alias("_text")]))


def texts_of(part: pa.RecordBatch, keep: Sequence[str], text_col: str) -> list[str | None]:
    place = part.schema.get_field_index
    if text_col in keep:
        return part.column(place("_doc")).field(list(keep).index(text_col)).to_pylist()
    return part.column(place("_text")).to_pylist()


_KEPT: dict[int, tuple[np.ndarray, ...]] = {}


def _constants(base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, those of its inverse, and a random odd value per byte; computed once per task."""
    if base not in _KEPT:
        powers = (np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(CHUNK + 4096, b, np.uint64)))) for b in (base, pow(base, -1, 2**64)))
        _KEPT[base] = (*powers, np.random.default_rng(base % 1000).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1))
    return _KEPT[base]


def prefix_hash(data: np.ndarray, base: int) -> np.ndarray:
    up, _, table = _constants(base)
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(table[data] * up[: len(data)], dtype=np.uint64)))


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of the bytes from start to end, wherever they are."""
    _, down, _ = _constants(base)
    out = (prefix[end] - prefix[start]) * down[start]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(29))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column without nulls, and where each text begins and the last one ends."""
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def token_hashes(data: np.ndarray, ends: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash per word of all texts, and the text it is in; words have no blanks in them, and with ``lower`` A to Z count as lower case.

    Bytes are read chunk by chunk, each of which ends where a word cannot go on.
    """
    hashes, texts, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    letters = _LOWER if lower else np.arange(256, dtype=np.uint8)
    while at < len(data):
        end = min(at + CHUNK, len(data))
        if end < len(data):
            blank = np.flatnonzero(_BLANK[data[at:end]])
            bound = ends[np.searchsorted(ends, end, side="right") - 1]
            cut = max(int(bound), at + int(blank[-1]) + 1 if len(blank) else 0)
            if cut <= at:  # one word is longer than a chunk
                cut = int(ends[np.searchsorted(ends, at, side="right")])
                for begin in range(at, cut, CHUNK):
                    blank = np.flatnonzero(_BLANK[data[begin : min(begin + CHUNK, cut)]])
                    if len(blank):
                        cut = begin + int(blank[0])
                        break
                whole = letters[data[at:cut]].tobytes()
                hashes.append(np.array([xxhash.xxh3_64_intdigest(whole)], np.uint64))
                texts.append(np.searchsorted(ends, [at], side="right") - 1)
                at = cut
                continue
            end = cut
        part = data[at:end]
        word = ~_BLANK[part]
        first = np.zeros(len(part) + 1, bool)
        low, high = np.searchsorted(ends, [at, end + 1])
        first[ends[low:high] - at] = True
        begins = word & (first[:-1] | ~np.concatenate(([False], word[:-1])))
        stops = word & (first[1:] | ~np.concatenate((word[1:], [False])))
        starts = np.flatnonzero(begins)
        hashes.append(range_hash(prefix_hash(letters[part], BASE), starts, np.flatnonzero(stops) + 1, BASE))
        texts.append(np.searchsorted(ends, starts + at, side="right") - 1)
        at = end
    return np.concatenate(hashes), np.concatenate(texts)


def _bitmap_rows(col: str):
    def run(table: pa.Table) -> pa.Table:
        """One chunk of the filter: 8192 bits, set where the low bits of a hash fall."""
        hashes = table[col].to_numpy()
        bits = np.zeros(8192, np.uint8)
        bits[hashes & 8191] = 1
        chunk = int(hashes[0] & ((1 << FILTER_BITS) - 1)) >> 13
        return pa.table({"chunk": pa.array([chunk], pa.int64()), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    return run


def bitmap(df: DataFrame, col: str) -> np.ndarray:
    """Which low bits occur among 64-bit hashes, in a bitmap of fixed size (8 MB).

    It spares most rows without a partner a shuffle as long as it is sparse. What
    passes has to be joined exactly, so a full one only spares less.
    """
    chunk = F.shiftright(F.col(col).bitwiseAND(F.lit((1 << FILTER_BITS) - 1)), 13)
    whole = np.zeros(((1 << FILTER_BITS) >> 13, 1024), np.uint8)
    parts = df.select(col).distinct().groupBy(chunk.alias("_chunk")).applyInArrow(_bitmap_rows(col), "chunk long, bits binary")
    for row in parts.collect():  # 8192 rows of 1 KB at most
        whole[row["chunk"]] = np.frombuffer(row["bits"], np.uint8)
    return whole.ravel()


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    low = hashes.view(np.uint64) & np.uint64((1 << FILTER_BITS) - 1)
    return (bits[(low >> np.uint64(3)).astype(np.int64)] >> (7 - (low & np.uint64(7))).astype(np.uint8)) & 1 == 1
