"""Word sequences that an earlier document holds too, found by fixed blocks of it that every rolling window is held against."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteledger.operators import staged

from .common import bitmap, in_bitmap, release, rows_of, shingle_hashes, text_bytes, token_hashes
from .suffix_dedup import _read as read_texts

WINDOW = 13
# Runs are short, so that their arrays stay in the processor's cache and a task needs little memory.
SLICE_BYTES = 1 << 19
SLICE_WORDS = 1 << 16
OTHER = np.uint64(0xA24BAED4963EE407)


class Run:
    """Neighbouring words of some texts of a batch: their hashes, texts and places in them; windows begin at the first ``own`` of them."""

    def __init__(self, words: np.ndarray, text: np.ndarray, place: np.ndarray, own: int, window: int):
        self.words, self.text, self.place, self.window, self.block = words, text, place, window, (window + 1) // 2
        starts = np.arange(max(min(own, len(words) - window + 1), 0))
        self.whole = text[starts] == text[starts + window - 1]
        #: One hash for each block of words that some window begins with or holds.
        self.blocks = shingle_hashes(words, self.block) if len(starts) else np.zeros(0, np.uint64)
        self.blocks = self.blocks[: len(starts) + window - self.block]

    def least(self) -> np.ndarray:
        """The smallest of the block hashes in each window: equal windows have equal ones."""
        out = self.blocks[: len(self.whole)]
        for k in range(1, self.window - self.block + 1):
            out = np.minimum(out, self.blocks[k : k + len(out)])
        return out

    def alive(self, known: np.ndarray) -> np.ndarray:
        """Windows that may occur in another text."""
        out = self.whole.copy()
        out[out] = in_bitmap(known, self.least()[out])
        return out

    def inside(self, windows: np.ndarray) -> np.ndarray:
        """Blocks that lie in one of the given windows."""
        out = np.zeros(len(self.blocks), bool)
        for k in range(self.window - self.block + 1):
            out[k : k + len(windows)] |= windows
        return out

    def over(self, blocks: np.ndarray) -> np.ndarray:
        """Windows that hold one of the given blocks."""
        out = np.zeros(len(self.whole), bool)
        for k in range(self.window - self.block + 1):
            out |= blocks[k : k + len(out)]
        return out


def runs(part: pa.RecordBatch, window: int) -> Iterator[Run]:
    """All words of a batch, in runs of bounded size that overlap by a window."""
    data, ends = text_bytes(part.column(part.schema.get_field_index("_text")))
    begin = 0
    while begin < len(part):
        stop = min(max(int(np.searchsorted(ends, ends[begin] + SLICE_BYTES, side="right")) - 1, begin + 1), len(part))
        words, text = token_hashes(data[ends[begin] : ends[stop]], ends[begin : stop + 1] - ends[begin], lower=False)
        place = np.arange(len(words)) - np.searchsorted(text, text)
        for at in range(0, len(words), SLICE_WORDS):
            end = min(at + SLICE_WORDS + window - 1, len(words))
            yield Run(words[at:end], text[at:end] + begin, place[at:end], min(SLICE_WORDS, len(words) - at), window)
        begin = stop


def _batch(schema: pa.Schema, *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _least_rows(window: int):
    schema = pa.schema([("h", pa.int64()), ("n", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for r in runs(part, window):
                least, text = r.least()[r.whole], r.text[: len(r.whole)][r.whole]
                first = np.concatenate(([True], (least[1:] != least[:-1]) | (text[1:] != text[:-1]))) if len(least) else np.zeros(0, bool)
                least, text = least[first], text[first]
                by = np.lexsort((text, least))
                least, text = least[by], text[by]
                if len(least):
                    new = np.concatenate(([True], least[1:] != least[:-1]))
                    each = new | np.concatenate(([True], text[1:] != text[:-1]))
                    yield _batch(schema, least[new], np.add.reduceat(each.astype(np.int64), np.flatnonzero(new)))

    return run


def _probe_rows(window: int, known: np.ndarray):
    """For each block of a window that may occur elsewhere: the first document that has it as one of its fixed blocks, and the last one with it anywhere."""
    schema = pa.schema([("h", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            docs = part.column(part.schema.get_field_index("_doc")).to_numpy()
            for r in runs(part, window):
                at = np.flatnonzero(r.inside(r.alive(known)))
                if len(at):
                    doc, fixed = docs[r.text[at]], r.place[at] % r.block == 0
                    by = np.argsort(r.blocks[at], kind="stable")
                    h, doc, fixed = r.blocks[at][by], doc[by], fixed[by]
                    new = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
                    first = np.minimum.reduceat(np.where(fixed, doc, np.iinfo(np.int64).max), new)
                    there = np.logical_or.reduceat(fixed, new)
                    columns = [pa.array(h[new].view(np.int64)), pa.array(first, mask=~there), pa.array(np.maximum.reduceat(doc, new))]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


_KEYS = pa.schema([(n, pa.int64()) for n in ("k1", "k2", "_doc")])
_WINDOWS = pa.schema([*_KEYS, ("_t", pa.int64()), ("at", pa.int64())])


def _window_rows(window: int, known: np.ndarray, hit: np.ndarray, shared: np.ndarray | None = None):
    """Hits extended to all windows of words around them; with ``shared``, only windows that may be among these, and their places."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            docs, ties = (part.column(part.schema.get_field_index(c)).to_numpy() for c in ("_doc", "_t"))
            for r in runs(part, window):
                alive = r.alive(known)
                blocks = r.inside(alive)
                blocks[blocks] = in_bitmap(hit, r.blocks[blocks])
                at = np.flatnonzero(alive & r.over(blocks))
                if len(at):
                    k1, k2 = (shingle_hashes(r.words ^ salt, window)[at] for salt in (np.uint64(0), OTHER))
                    if shared is None:
                        yield _batch(_KEYS, k1, k2, docs[r.text[at]])
                        continue
                    two = in_bitmap(shared, k1)
                    at = at[two]
                    yield _batch(_WINDOWS, k1[two], k2[two], docs[r.text[at]], ties[r.text[at]], r.place[at])

    return run


def repeated_windows(read: DataFrame, window: int = WINDOW) -> DataFrame:
    """(_doc, _t, at): windows of words whose sequence a document with a smaller id holds.

    Every window holds one whole block of its document's fixed grid of blocks of
    (window + 1) / 2 words. So of two equal windows the earlier one has a fixed
    block that the later one meets as a rolling block.
    """
    spark = read.sparkSession
    # Windows without a counterpart are spared the rest: equal windows have the same smallest block.
    counted = read.select("_text").mapInArrow(_least_rows(window), "h long, n long")
    twice = staged(counted.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h"))
    release(spark)
    known = bitmap(twice, "h")
    # The index of fixed blocks and the probes are counted together: a block is hit if a later document has it anywhere.
    probes = read.select("_doc", "_text").mapInArrow(_probe_rows(window, known), "h long, first long, last long")
    hit = staged(probes.groupBy("h").agg(F.min("first").alias("first"), F.max("last").alias("last")).where("first < last").select("h"))
    release(spark)
    # Windows are made twice, once to find the first document of each and once to look it up, so that they are never written as a whole.
    texts, around = read.select("_doc", "_t", "_text"), bitmap(hit, "h")
    keys = texts.mapInArrow(_window_rows(window, known, around), ", ".join(f"{n} long" for n in _KEYS.names))
    first = keys.groupBy("k1", "k2").agg(F.min("_doc").alias("_first"), F.max("_doc").alias("_last"))
    first = staged(first.where("_first < _last").select("k1", "k2", "_first"))
    release(spark)
    windows = texts.mapInArrow(_window_rows(window, known, around, bitmap(first, "k1")), ", ".join(f"{n} long" for n in _WINDOWS.names))
    return windows.join(first, ["k1", "k2"]).where("_doc > _first").select("_doc", "_t", "at")


def _kept_rows(window: int, with_text: bool, without: np.ndarray | None = None):
    """Words that are left of every text; with ``without``, only of texts that surely lose none."""
    names = ["_id", "n_words", "n_removed", "kept_sha256"] + ["kept"] * with_text
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string()] + [pa.string()] * with_text

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if without is not None:
                part = part.filter(pa.array(~in_bitmap(without, part.column(part.schema.get_field_index("_h")).to_numpy())))
            rows = []
            for doc, text, gone in rows_of(part, "_id", "_text", *(["_gone"] if without is None else ["_id"])):
                words = text.encode().split()  # at the blanks that part words, as bytes
                n = len(words)
                if without is None and gone:
                    edge = np.zeros(n + 1, np.int64)
                    starts = np.array(gone)
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, starts + window, -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
                kept = b" ".join(words)
                rows.append((doc, n, n - len(words), hashlib.sha256(kept).hexdigest(), *([kept.decode()] if with_text else [])))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)

    return run


def _only(inside: np.ndarray):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield part.filter(pa.array(in_bitmap(inside, part.column(part.schema.get_field_index("_h")).to_numpy())))

    return run


def remove_repeated_words(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """Every document without the words covered by a window of ``window`` words that also starts in a document with a smaller id.

    Documents are cut into fixed blocks, which are indexed; every rolling window
    of that many words is held against the index, and hits are extended to all
    windows around them, which are compared by 128 bits. Windows with an earlier
    counterpart that overlap or touch make up the maximal repeats.

    Result: id, n_words, n_removed, kept_sha256 of the words left, joined by one
    space, and with ``with_text`` these as ``kept``. Windows are judged on the input.
    Null or blank texts have no words; texts with fewer words than a window lose
    none. A null id is last; rows that share an id are not earlier than each other.
    An empty table gives no rows. Only texts that may lose words are shuffled.
    """
    read = read_texts(docs, id_col, text_col)
    late = repeated_windows(read, window)
    gone = staged(late.groupBy("_doc", "_t").agg(F.collect_list("at").alias("_gone")))  # of one text
    release(read.sparkSession)
    some = bitmap(gone.select(F.xxhash64("_doc", "_t").alias("_h")), "_h")
    hashed = read.withColumn("_h", F.xxhash64("_doc", "_t"))
    kinds = "_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text
    whole = hashed.mapInArrow(_kept_rows(window, with_text, some), kinds)
    touched = hashed.mapInArrow(_only(some), hashed.schema)
    cut = touched.join(gone, ["_doc", "_t"], "left").select("_id", "_text", "_gone").mapInArrow(_kept_rows(window, with_text), kinds)
    return whole.unionByName(cut).withColumnRenamed("_id", id_col)
