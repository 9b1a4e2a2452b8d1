"""Byte strings that occur again anywhere in the corpus, found by bounded interval expansion on Burrows-Wheeler transforms."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteledger.operators import staged

from .common import BASE, CHUNK, OTHER_BASE, batches, bitmap, in_bitmap, prefix_hash, range_hash, release, rows_of, text_bytes

LEAST = 100
GRAM = 40
BUCKET_BYTES = 1 << 20
HOT_PIECES = 4096
TASK_BYTES = 64 << 20
LAST = (1 << 63) - 1
_PLACE = np.uint64((1 << 22) - 1)  # a place in a chunk


def pieces(whole: np.ndarray, ends: np.ndarray, least: int = LEAST, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, start, size, hash) of the pieces of all texts of a batch, given their bytes and bounds.

    Every window of ``least`` bytes has an anchor, the leftmost of the strings of
    ``gram`` bytes in it with the smallest hash, so equal windows have equal
    anchors at equal places. Neighbouring windows with one anchor place make a
    piece. Windows are read chunk by chunk; those that reach into the next text do not count.
    """
    found, width = [], least - gram + 1
    for at in range(0, len(whole) - least + 1, CHUNK):
        data = whole[at : at + CHUNK + least - 1]
        starts = np.arange(len(data) - gram + 1)
        hashes = range_hash(prefix_hash(data, BASE), starts, starts + gram, BASE)
        low, size = (hashes & ~_PLACE) | starts.view(np.uint64), 1
        while size * 2 <= width:
            low, size = np.minimum(low[:-size], low[size:]), size * 2
        if size < width:
            low = np.minimum(low[: len(low) - (width - size)], low[width - size :])
        low = low[: len(data) - least + 1] & _PLACE
        own = np.ones(len(low) + 1, bool)
        own[-1] = False
        for end in (ends[np.searchsorted(ends, at, side="right") : np.searchsorted(ends, at + len(data), side="right")] - at).tolist():
            own[max(0, end - least + 1) : end] = False
        changed = np.concatenate(([True], low[1:] != low[:-1]))
        begin = np.flatnonzero(own[:-1] & (changed | ~np.concatenate(([False], own[:-2]))))
        # A piece ends where the next one begins or where windows no longer count.
        stop = np.flatnonzero(~own)
        end = np.minimum(np.append(begin[1:], len(low)), stop[np.searchsorted(stop, begin)]) + least - 1
        if len(begin):
            found.append((hashes[low[begin].view(np.int64)], begin + at, end - begin, range_hash(prefix_hash(data, OTHER_BASE), begin, end, OTHER_BASE)))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def suffixes(chars: np.ndarray, room: np.ndarray, longest: int) -> np.ndarray:
    """Suffix array of texts that each end in a 0 of their own; ``room`` is how many characters are left at a place, the 0 included.

    Ranks of prefixes are doubled until they cover the longest text; equal
    suffixes go in the order of their texts, as the ends differ.
    """
    n, size = len(chars), 7
    key = np.zeros(n, np.int64)
    for k in range(size):
        shifted = np.zeros(n, np.int64)
        shifted[: n - k] = chars[k:]
        key = (key << 9) | np.where(room > k, shifted, 0)
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    change = np.concatenate(([True], key[order][1:] != key[order][:-1]))
    rank[order] = np.flatnonzero(change)[np.cumsum(change) - 1]  # place of the first equal one
    while size < longest:
        same = np.zeros(n, bool)
        same[:-1] = ~change[1:]
        same[1:] |= ~change[1:]
        at = np.flatnonzero(same)  # places in the order that are not settled
        if not len(at):
            break
        mine = order[at]
        after = np.where(room[mine] > size, rank[np.minimum(mine + size, n - 1)] + 1, 0)
        by = np.lexsort((after, rank[mine]))
        mine, after = mine[by], after[by]
        first = rank[mine]
        order[at] = mine
        new = np.concatenate(([True], (first[1:] != first[:-1]) | (after[1:] != after[:-1])))
        change[at] = new
        rank[mine] = at[np.flatnonzero(new)[np.cumsum(new) - 1]]
        size *= 2
    return order[np.lexsort((order, rank[order]))]


def repeated(chars: np.ndarray, order: np.ndarray, texts: int, least: int) -> np.ndarray:
    """For each place of the suffix array, whether its suffix shares at least ``least`` characters with the one before.

    Intervals of suffixes that begin alike are extended backwards on the
    Burrows-Wheeler transform, breadth first, so common prefixes are found by
    increasing value: an interval of strings of n characters ends where the
    common prefix is n - 1, unless a shorter one was found there. The search stops
    at ``least``; what is open then is at least as long.
    """
    n = len(order)
    before = chars[order - 1]
    before[order == 0] = 0
    by = np.argsort(before, kind="stable")  # last-to-first mapping, and the places of each character
    step = np.empty(n, np.int64)
    step[by] = np.arange(n)
    # The ends are characters of their own, and their suffixes come first; no string goes back over an end.
    previous = np.full(n, -1, np.int64)
    alike = before[by][1:] == before[by][:-1]
    previous[by[1:]] = np.where(alike, by[:-1], -1)
    following = np.full(n, n, np.int64)
    following[by[:-1]] = np.where(alike, by[1:], n)
    open_ = np.ones(n + 1, bool)
    open_[0] = open_[n] = False
    counts = np.bincount(chars, minlength=257)
    ends = np.cumsum(counts)
    present = np.flatnonzero(counts[1:]) + 1
    low = np.concatenate((np.arange(texts), ends[present - 1]))
    high = np.concatenate((np.arange(1, texts + 1), ends[present]))
    for _ in range(least):
        keep = open_[high]
        low, high = low[keep], high[keep]
        open_[high] = False
        if not len(low):
            break
        single = high - low == 1
        one = low[single]
        one = one[before[one] > 0]
        next_low = [step[one]]
        next_high = [step[one] + 1]
        low, high = low[~single], high[~single]
        size = high - low
        owner = np.repeat(np.arange(len(low)), size)
        at = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(size.sum())
        used = before[at] > 0
        at, owner = at[used], owner[used]
        is_first, is_last = previous[at] < low[owner], following[at] >= high[owner]
        # First and last places of each character in an interval, both in the order of interval and character.
        first, last = at[is_first], at[is_last]
        first = first[np.argsort(owner[is_first] * 512 + before[first], kind="stable")]
        last = last[np.argsort(owner[is_last] * 512 + before[last], kind="stable")]
        next_low.append(step[first])
        next_high.append(step[last] + 1)
        low, high = np.concatenate(next_low), np.concatenate(next_high)
    return open_[:n]


def earlier(texts: list[bytes], doc: np.ndarray, tie: np.ndarray, start: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first offset, last offset) of the runs of windows that occur earlier, by (doc, tie, place), in these texts."""
    sizes = np.array([len(t) + 1 for t in texts])
    if not len(sizes) or sizes.max() <= least:
        return (np.zeros(0, np.int64),) * 3
    chars = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int64) + 1
    ends = np.cumsum(sizes) - 1
    chars[ends] = 0
    of = np.repeat(np.arange(len(texts)), sizes)
    room = ends[of] - np.arange(len(chars)) + 1
    order = suffixes(chars, room, int(sizes.max()))
    alike = repeated(chars, order, len(texts), least)
    member = alike.copy()
    member[:-1] |= alike[1:]
    group = np.cumsum(~alike)[member]
    at = order[member]
    text, offset = of[at], at - (ends[of[at]] - sizes[of[at]] + 1)
    if not len(group):
        return group, offset, offset
    by = np.lexsort((start[text] + offset, tie[text], doc[text], group))
    group, text, offset = group[by], text[by], offset[by]
    late = np.concatenate(([False], group[1:] == group[:-1]))
    text, offset = text[late], offset[late]
    by = np.lexsort((offset, text))
    text, offset = text[by], offset[by]
    if not len(text):
        return text, offset, offset
    new = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (offset[1:] != offset[:-1] + 1))))
    return text[new], offset[new], offset[np.concatenate((new[1:], [len(text)])) - 1]


def _signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def _anchor_rows(least: int, gram: int):
    schema = pa.schema([("anchor", pa.int64()), ("n", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            anchors = pieces(*text_bytes(part.column(part.schema.get_field_index("_text"))), least, gram)[0]
            values, n = np.unique(anchors, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(_signed(values)), pa.array(n.astype(np.int64))], schema=schema)

    return run


_PLACES = pa.schema([(n, pa.int64()) for n in ("_doc", "_t", "start", "size", "anchor", "hash")])


def _place_rows(least: int, gram: int, known: np.ndarray):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            place = part.schema.get_field_index
            whole, ends = text_bytes(part.column(place("_text")))
            anchor, start, size, mixed = pieces(whole, ends, least, gram)
            keep = in_bitmap(known, anchor)
            anchor, start, size, mixed = anchor[keep], start[keep], size[keep], mixed[keep]
            text = np.searchsorted(ends, start, side="right") - 1
            columns = [part.column(place(c)).to_numpy()[text] for c in ("_doc", "_t")]
            columns += [start - ends[text], size, _signed(anchor), _signed(mixed)]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], schema=_PLACES)

    return run


_CUT = pa.schema([("_doc", pa.int64()), ("_t", pa.int64()), ("start", pa.int64()), ("anchor", pa.int64()), ("variants", pa.int64()), ("piece", pa.binary())])


def _cut_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        rows = []
        for doc, t, text, places in rows_of(part, "_doc", "_t", "_text", "_places"):
            data = text.encode()
            rows += [(doc, t, p["start"], p["anchor"], p["variants"], data[p["start"] : p["start"] + p["size"]]) for p in places]
        yield batches({f.name: [r[k] for r in rows] for k, f in enumerate(_CUT)}, _CUT)


_GONE = pa.schema([(n, pa.int64()) for n in ("_doc", "_t", "begin", "end")])


def _expand(least: int):
    def run(table: pa.Table) -> pa.Table:
        doc, tie, start = (table[n].to_numpy() for n in ("_doc", "_t", "start"))
        text, first, last = earlier(table["piece"].to_pylist(), doc, tie, start, least)
        columns = doc[text], tie[text], start[text] + first, start[text] + last + least
        return pa.Table.from_arrays([pa.array(c.astype(np.int64)) for c in columns], schema=_GONE)

    return run


def _window_rows(least: int):
    schema = pa.schema([(n, pa.int64()) for n in ("anchor", "h1", "h2", "_doc", "_t", "at")])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for doc, t, start, anchor, piece in rows_of(part, "_doc", "_t", "start", "anchor", "piece"):
                data = np.frombuffer(piece, np.uint8)
                at = np.arange(len(data) - least + 1)
                hashes = [_signed(range_hash(prefix_hash(data, b), at, at + least, b)) for b in (BASE, OTHER_BASE)]
                columns = [np.full(len(at), anchor), *hashes, np.full(len(at), doc), np.full(len(at), t), at + start]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], schema=schema)

    return run


def _read(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _doc, _t, _text): a null id is last; ``_t`` tells texts of one id apart where ids repeat."""
    own = F.col(f"`{id_col}`").cast("long")
    read = docs.select(own.alias("_id"), F.coalesce(own, F.lit(LAST)).alias("_doc"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    unique = read.groupBy("_doc").agg(F.count("*").alias("_n")).where("_n > 1").isEmpty()
    return read.withColumn("_t", F.lit(0).cast("long") if unique else F.xxhash64("_text"))


def repeated_spans(read: DataFrame, least: int = LEAST, gram: int = GRAM, bucket_bytes: int = BUCKET_BYTES, hot_pieces: int = HOT_PIECES) -> DataFrame:
    """(_doc, _t, begin, end): byte spans covered by strings of ``least`` bytes that start earlier; spans may overlap."""
    spark = read.sparkSession
    # Anchors are counted per batch and task before they are shuffled; one that occurs once leads to no repeat.
    counted = read.select("_text").mapInArrow(_anchor_rows(least, gram), "anchor long, n long")
    twice = staged(counted.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor"))
    release(spark)
    found = read.select("_doc", "_t", "_text").mapInArrow(_place_rows(least, gram, bitmap(twice, "anchor")), ", ".join(f"{n} long" for n in _PLACES.names))
    places = staged(found.join(twice, "anchor"))
    release(spark)
    # Copies of a piece count as one, the first of them. Sides of joins that were reduced are staged, so that
    # both sides are plain shuffles and a hot key is split.
    where = F.struct("_doc", "_t", "start")
    first = staged(places.groupBy("anchor", "hash", "size").agg(F.min(where).alias("_first")))
    copies = places.join(first, ["anchor", "hash", "size"]).where(where != F.col("_first"))
    copies = copies.select("_doc", "_t", F.col("start").alias("begin"), (F.col("start") + F.col("size")).alias("end"))
    # Different pieces with one anchor may share windows; a piece without another shares none.
    mixed = staged(first.groupBy("anchor").agg(F.count("*").alias("variants")).where("variants > 1"))
    some = staged(first.join(mixed, "anchor").select("anchor", "size", "variants", "_first.*"))
    release(spark)
    total = some.where(F.col("variants") <= hot_pieces).agg(F.sum("size")).first()[0] or 0
    lists = some.groupBy("_doc", "_t").agg(F.collect_list(F.struct("start", "size", "anchor", "variants")).alias("_places"))  # of one text
    cut = staged(read.join(lists, ["_doc", "_t"]).select("_doc", "_t", "_text", "_places").mapInArrow(_cut_rows, "_doc long, _t long, start long, anchor long, variants long, piece binary"))
    release(spark)
    buckets = max(1, math.ceil(total / bucket_bytes))
    kinds = ", ".join(f"{n} long" for n in _GONE.names)
    # Sorting suffixes is work for the processor, so small shuffles are not gathered into few tasks.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / TASK_BYTES))
    cold = cut.where(F.col("variants") <= hot_pieces).withColumn("_bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets))).repartition(tasks, "_bucket")
    expanded = staged(cold.groupBy("_bucket").applyInArrow(_expand(least), kinds))
    # Too many pieces with one anchor for a bucket: their windows are grouped one by one, which spreads them.
    hot = cut.where(F.col("variants") > hot_pieces)
    windows = staged(hot.mapInArrow(_window_rows(least), "anchor long, h1 long, h2 long, _doc long, _t long, at long"))
    at = F.struct("_doc", "_t", "at")
    heads = staged(windows.groupBy("anchor", "h1", "h2").agg(F.min(at).alias("_first")))
    late = windows.join(heads, ["anchor", "h1", "h2"]).where(at != F.col("_first"))
    late = late.select("_doc", "_t", F.col("at").alias("begin"), (F.col("at") + least).alias("end"))
    release(spark)
    return copies.unionByName(expanded).unionByName(late)


def _without(with_text: bool):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()] + [pa.binary()] * with_text
        for part in parts:
            rows = []
            for doc, text, gone in rows_of(part, "_id", "_text", "_gone"):
                data, kept, at, spans, end = text.encode(), [], 0, 0, -1
                for span in sorted((g["begin"], g["end"]) for g in gone or ()):
                    if span[0] > end:  # spans that touch are one
                        spans += 1
                        kept.append(data[at : span[0]])
                    end = max(end, span[1])
                    at = end
                kept = b"".join([*kept, data[at:]])
                rows.append((doc, len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False, **options) -> DataFrame:
    """Every document without the bytes covered by a string of ``least`` bytes that also starts earlier in the corpus.

    Result: id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256,
    and with ``with_text`` the bytes that are left as ``kept``. Earlier means a
    smaller id, or the same document and a smaller start; strings are judged on the
    input. Null text is empty, a null id is last, rows that repeat id and text are
    one document, of texts that share an id the order is that of their hash. Texts
    shorter than ``least`` lose nothing; an empty table gives no rows.
    """
    read = _read(docs, id_col, text_col)
    gone = repeated_spans(read, **options).groupBy("_doc", "_t").agg(F.collect_list(F.struct("begin", "end")).alias("_gone"))  # of one text
    joined = read.join(gone, ["_doc", "_t"], "left").select("_id", "_text", "_gone")
    kinds = "_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return joined.mapInArrow(_without(with_text), kinds).withColumnRenamed("_id", id_col)
