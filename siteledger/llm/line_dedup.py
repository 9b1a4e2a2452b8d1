"""Repeated passages of lines, found by windows that their content bounds, or by chunks, and removed after their bytes were compared."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteledger.operators import staged

from .common import batches, rows_of

ROLL = 2
SPREAD = 4
LEAST_LINES = 2
LEAST_BYTES = 40
_WINDOWS = pa.schema([("_doc", pa.int64()), ("_t", pa.int64()), ("at", pa.int64()), ("lines", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64())])
_WINDOW_BYTES = pa.schema([("_doc", pa.int64()), ("_t", pa.int64()), ("at", pa.int64()), ("lines", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("data", pa.binary())])
_MERGED = pa.schema([("_d", pa.int64()), ("_u", pa.int64()), ("removed", pa.int64()), ("spans", pa.string())])
_CHUNKS = pa.schema([("_doc", pa.int64()), ("_t", pa.int64()), ("at", pa.int64()), ("lines", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64())])
_BYTES = pa.schema([("_doc", pa.int64()), ("_t", pa.int64()), ("at", pa.int64()), ("lines", pa.int64()), ("chunk", pa.binary())])


def boundaries(lines: list[bytes], roll: int = ROLL, spread: int = SPREAD) -> list[int]:
    """Ends of the chunks: after each line where a rolling hash over the last ``roll`` line hashes is 0 modulo ``spread``, and at the end.

    A boundary depends on ``roll`` lines alone, so lines put in elsewhere shift nothing.
    """
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, lines), np.uint64, len(lines))
    rolled = np.zeros(len(lines), np.uint64)
    for k in range(roll):
        rolled[k:] = rolled[k:] * np.uint64(0x9E3779B97F4A7C15) + hashes[: len(lines) - k]
    ends = np.flatnonzero((rolled >> np.uint64(33)) % np.uint64(spread) == 0) + 1
    return sorted({*ends.tolist(), len(lines)})


def chunks(text: str, roll: int = ROLL, spread: int = SPREAD) -> Iterator[tuple[int, int, bytes]]:
    """(first line, lines, bytes) of every chunk of the text."""
    lines, at = text.encode().split(b"\n"), 0
    for end in boundaries(lines, roll, spread):
        yield at, end - at, b"\n".join(lines[at:end])
        at = end


def _hash_rows(roll: int, spread: int, least: int, least_bytes: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = []
            for doc, t, text in rows_of(part, "_doc", "_t", "_text"):
                n = 0
                for at, lines, data in chunks(text, roll, spread):
                    n += lines
                    if lines >= least and len(data) >= least_bytes:
                        digest = np.frombuffer(xxhash.xxh3_128_digest(data), np.int64).tolist()
                        rows.append((doc, t, at, lines, *digest))
                rows.append((doc, t, -1, n, 0, 0))  # the document itself
            yield batches({f.name: [r[k] for r in rows] for k, f in enumerate(_CHUNKS)}, _CHUNKS)

    return run


def _byte_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        rows = []
        for doc, t, text, places in rows_of(part, "_doc", "_t", "_text", "_places"):
            lines = text.encode().split(b"\n")
            rows += [(doc, t, p["at"], p["lines"], b"\n".join(lines[p["at"] : p["at"] + p["lines"]])) for p in places]
        yield batches({f.name: [r[k] for r in rows] for k, f in enumerate(_BYTES)}, _BYTES)


def _same(left: DataFrame, right: DataFrame):
    return left["_doc"].eqNullSafe(right["_doc"]) & (left["_t"] == right["_t"])


def repeated_chunks(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", roll: int = ROLL, spread: int = SPREAD,
    least: int = LEAST_LINES, least_bytes: int = LEAST_BYTES,
) -> DataFrame:
    """(id, _t, lines, removed, spans) of every document: chunks of lines that occur earlier in the corpus.

    Finds passages in part, and short ones seldom; ``repeated_passages`` finds them whole. Lines are cut into chunks at boundaries that their content chooses. Chunks
    of at least ``least`` lines and ``least_bytes`` bytes count; of those with
    equal bytes the first by (id, text, line) stays. Hashes of 128 bits find what may be
    repeated, so the bytes of other chunks are never moved; those of repeated ones are
    grouped by the bytes themselves. ``spans`` lists removed lines as
    start:count, joined by commas. ``_t`` tells rows of one id apart. Null text is one
    empty line; a null id comes first; rows repeated whole are one document; an
    empty table gives no rows. The id is an integer.
    """
    read = docs.select(F.col(f"`{id_col}`").cast("long").alias("_doc"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    read = read.withColumn("_t", F.xxhash64("_text"))
    small = staged(read.mapInArrow(_hash_rows(roll, spread, least, least_bytes), "_doc long, _t long, at long, lines long, h1 long, h2 long"))
    every = small.where("at < 0").select("_doc", "_t", "lines").distinct()
    found = small.where("at >= 0")
    # Staged, so that the joins have plain shuffles on both sides and split a hot chunk.
    twice = staged(found.groupBy("h1", "h2").agg(F.count("*").alias("_n")).where("_n > 1").select("h1", "h2"))
    places = found.join(twice, ["h1", "h2"]).groupBy("_doc", "_t").agg(F.collect_set(F.struct("at", "lines")).alias("_places"))  # chunks of one document
    texts = read.join(places.withColumnsRenamed({"_doc": "_d", "_t": "_u"}), F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_t") == F.col("_u")))
    cut = texts.select("_doc", "_t", "_text", "_places").mapInArrow(_byte_rows, "_doc long, _t long, at long, lines long, chunk binary")
    # A repeated row has its chunks once; the bytes are shuffled by a hash and compared as they are.
    some = staged(cut)
    order = F.struct("_doc", "_t", "at")
    first = staged(some.groupBy("chunk").agg(F.min(order).alias("_first")))
    gone = some.join(first, "chunk").where(order != F.col("_first")).select("_doc", "_t", "at", "lines").distinct()
    lists = gone.groupBy("_doc", "_t").agg(F.sum("lines").alias("removed"), F.sort_array(F.collect_list(F.struct("at", "lines"))).alias("_gone"))
    text = F.array_join(F.transform("_gone", lambda g: F.concat(g["at"].cast("string"), F.lit(":"), g["lines"].cast("string"))), ",")
    joined = every.join(lists, _same(every, lists), "left")
    return joined.select(
        every["_doc"].alias(id_col), every["_t"], "lines", F.coalesce("removed", F.lit(0)).alias("removed"), F.coalesce(text, F.lit("")).alias("spans")
    )


def windows(lines: list[bytes], least: int = LEAST_LINES, least_bytes: int = LEAST_BYTES) -> list[tuple[int, int]]:
    """(first line, lines) of the shortest windows of at least ``least`` lines and ``least_bytes`` bytes from every line on and up to every line.

    Whatever passage is that long holds the windows from its lines on and up to its
    lines, as far as they fit, and these cover each of its lines. So a passage
    occurs elsewhere only if windows that cover it do.
    """
    ends = np.concatenate(([0], np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines)) + 1)))
    n, at = len(lines), np.arange(len(lines))
    stop = np.maximum(at + least, np.searchsorted(ends, ends[:-1] + least_bytes + 1))
    start = np.minimum(at + 1 - least, np.searchsorted(ends, ends[1:] - least_bytes - 1, side="right") - 1)
    pairs = np.concatenate((np.stack((at, stop), 1)[stop <= n], np.stack((start, at + 1), 1)[start >= 0]))
    if not len(pairs):
        return []
    pairs = np.unique(pairs, axis=0)
    return list(zip(pairs[:, 0].tolist(), (pairs[:, 1] - pairs[:, 0]).tolist(), strict=True))


def _window_rows(least: int, least_bytes: int, digest: Callable[[bytes], bytes]):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = []
            for doc, t, text in rows_of(part, "_doc", "_t", "_text"):
                lines = text.encode().split(b"\n")
                for at, n in windows(lines, least, least_bytes):
                    rows.append((doc, t, at, n, *np.frombuffer(digest(b"\n".join(lines[at : at + n])), np.int64).tolist()))
                rows.append((doc, t, -1, len(lines), 0, 0))  # the document itself
            yield batches({f.name: [r[k] for r in rows] for k, f in enumerate(_WINDOWS)}, _WINDOWS)

    return run


def _window_bytes(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        for doc, t, text, places in rows_of(part, "_doc", "_t", "_text", "_places"):
            lines = text.encode().split(b"\n")
            rows = [(doc, t, p["at"], p["lines"], p["h1"], p["h2"], b"\n".join(lines[p["at"] : p["at"] + p["lines"]])) for p in places]
            yield batches({f.name: [r[k] for r in rows] for k, f in enumerate(_WINDOW_BYTES)}, _WINDOW_BYTES)


def _merged_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        rows = []
        for doc, t, places in rows_of(part, "_doc", "_t", "_late"):
            runs: list[list[int]] = []
            for p in sorted(places, key=lambda p: p["at"]):
                if runs and p["at"] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], p["at"] + p["lines"])
                else:
                    runs.append([p["at"], p["at"] + p["lines"]])
            rows.append((doc, t, sum(b - a for a, b in runs), ",".join(f"{a}:{b - a}" for a, b in runs)))
        yield batches({f.name: [r[k] for r in rows] for k, f in enumerate(_MERGED)}, _MERGED)


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LINES, least_bytes: int = LEAST_BYTES,
    digest: Callable[[bytes], bytes] = xxhash.xxh3_128_digest,
) -> DataFrame:
    """(id, _t, lines, removed, spans) of every document: all lines in passages that occur earlier in the corpus.

    A passage is a run of at least ``least`` lines and ``least_bytes`` bytes that
    stands with equal bytes at an earlier place by (id, text, line); places may
    overlap. ``windows`` of each text are compared, so none is missed and no passage is
    found in part. ``digest`` gives 128 bits that find what may be repeated; bytes of
    other windows are never moved. Those of one digest are compared by bytes. ``spans`` lists removed
    lines as start:count, joined by commas. ``_t`` tells rows of one id apart. Null text
    is one empty line; a null id comes first; rows repeated whole are one
    document; an empty table gives no rows. The id is an integer.
    """
    read = docs.select(F.col(f"`{id_col}`").cast("long").alias("_doc"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    read = read.withColumn("_t", F.xxhash64("_text"))
    kinds = "_doc long, _t long, at long, lines long, h1 long, h2 long"
    small = staged(read.mapInArrow(_window_rows(least, least_bytes, digest), kinds))
    every = small.where("at < 0").select("_doc", "_t", "lines").distinct()
    found = small.where("at >= 0")
    # Staged, so that the joins have plain shuffles on both sides and split a hot window.
    twice = staged(found.groupBy("h1", "h2").agg(F.count("*").alias("_n")).where("_n > 1").select("h1", "h2"))
    held = staged(found.join(twice, ["h1", "h2"]))
    places = held.groupBy("_doc", "_t").agg(F.collect_set(F.struct("at", "lines", "h1", "h2")).alias("_places"))  # windows of one document
    texts = read.join(places.withColumnsRenamed({"_doc": "_d", "_t": "_u"}), F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_t") == F.col("_u")))
    cut = texts.select("_doc", "_t", "_text", "_places").mapInArrow(_window_bytes, f"{kinds}, data binary")
    order = F.struct("_doc", "_t", "at")
    # One row per bytes, of which there is one per digest but for collisions: only those are joined by their bytes.
    named = staged(cut.groupBy("h1", "h2", "data").agg(F.min(order).alias("_first")).drop("data"))
    firsts = staged(named.groupBy("h1", "h2").agg(F.min("_first").alias("_first"), F.count("*").alias("_n")))
    late = held.join(firsts.where("_n = 1"), ["h1", "h2"]).where(order != F.col("_first")).select("_doc", "_t", "at", "lines")
    clash = firsts.where("_n > 1").select("h1", "h2")
    if not clash.isEmpty():
        some = staged(cut.join(clash, ["h1", "h2"]))
        first = staged(some.groupBy("data").agg(F.min(order).alias("_first")))
        late = late.unionByName(some.join(first, "data").where(order != F.col("_first")).select("_doc", "_t", "at", "lines"))
    lists = late.groupBy("_doc", "_t").agg(F.collect_set(F.struct("at", "lines")).alias("_late"))
    merged = lists.mapInArrow(_merged_rows, "_d long, _u long, removed long, spans string")
    joined = every.join(merged, F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_t") == F.col("_u")), "left")
    return joined.select(F.col("_doc").alias(id_col), "_t", "lines", F.coalesce("removed", F.lit(0)).alias("removed"), F.coalesce("spans", F.lit("")).alias("spans"))


def drop_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with repeated passages of lines cut out of the text; all other columns as they are."""
    return _without(docs, repeated_passages(docs, id_col, text_col, **options), id_col, text_col)


def drop_repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with repeated chunks of lines cut out of the text; all other columns as they are."""
    return _without(docs, repeated_chunks(docs, id_col, text_col, **options), id_col, text_col)


def _without(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    gone = found.where("removed > 0").select(F.col(id_col).alias("_d"), F.col("_t").alias("_u"), F.col("spans").alias("_spans"))
    packed = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(packed, F.col(f"`{id_col}`").cast("long").alias("_doc"), F.col(f"`{text_col}`").alias("_text"))
    key = F.col("_doc").eqNullSafe(F.col("_d")) & (F.xxhash64(F.coalesce("_text", F.lit(""))) == F.col("_u"))
    numbers = F.transform(F.split("_spans", ","), lambda s: F.struct(F.split(s, ":")[0].cast("int").alias("a"), F.split(s, ":")[1].cast("int").alias("n")))
    stay = F.filter(F.split("_text", "\n", -1), lambda _, i: ~F.exists(numbers, lambda s: (i >= s["a"]) & (i < s["a"] + s["n"])))
    left = F.when(F.col("_spans").isNull(), F.col("_text")).otherwise(F.array_join(stay, "\n"))
    joined = rows.join(gone, key, "left").withColumn("_left", left)
    return joined.select(*[F.col("_left").alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns])
