"""Sequences of a fixed window from documents of any length, packed by a histogram of lengths."""

from __future__ import annotations

import base64
import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteledger.operators import staged

from .common import batches, numbered, rows_of

WINDOW = 1024
CACHED_WORDS = 400_000
PIECES = pa.schema([("_row", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])
# A blank between two characters that are none always begins a new token of the vocabulary's pattern.
_BLANKS = re.compile(r"\s\s|^ | $")
_CUT = re.compile(r"(?<=\S) (?=\S)")


def added_tokens(vocabulary: str) -> dict[str, int]:
    """Ids of the tokens that the tokenizer file (.json) beside a rank file of the same name adds to the ranks."""
    with open(os.path.splitext(vocabulary)[0] + ".json", encoding="utf-8") as file:
        added = json.load(file).get("added_tokens", [])
    if odd := [t["content"] for t in added if t["single_word"] or t["lstrip"] or t["rstrip"]]:
        raise ValueError(f"added tokens that take more or less than their own text: {odd}")
    return {t["content"]: t["id"] for t in added}


class Ids(dict):
    """Ids of words with the blank before them, as unsigned 32-bit values; keeps those of the last words seen.

    With ``added``, added tokens that stand in a text have ids of their own, and the text before
    and after them is encoded by itself, as the tokenizer does; else they are spelled out.
    """

    def __init__(self, vocabulary: str, added: bool = False):
        import tiktoken
        from public_tokenizers import PATTERN

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.added = {word: array("I", [i]).tobytes() for word, i in (added_tokens(vocabulary) if added else {}).items()}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")").split if self.added else None

    def __missing__(self, word: str) -> bytes:
        ids = array("I", self.encode(" " + word)).tobytes()
        if len(word) <= 64:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = ids
        return ids

    def of(self, text: str) -> bytes:
        if not any(word in text for word in self.added):
            return self.plain(text)
        return b"".join(self.added[x] if k % 2 else self.plain(x) for k, x in enumerate(self.split(text)) if x)

    def plain(self, text: str) -> bytes:
        words = _CUT.split(text) if _BLANKS.search(text) else text.split(" ")
        return array("I", self.encode(words[0])).tobytes() + b"".join(map(self.__getitem__, words[1:]))


def default_vocabulary() -> str:
    from public_tokenizers import path

    return path("byte_bpe_50k.tiktoken")


def _piece_rows(vocabulary: str, window: int, added: bool):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = Ids(vocabulary, added)
        for part in parts:
            out = {name: [] for name in PIECES.names}
            for row, text in rows_of(part, "_row", "_text"):
                data = memoryview(ids.of(text) + b"\0\0\0\0")
                total = len(data) // 4
                for start in range(0, total, window):
                    length = min(window, total - start)
                    crc = zlib.crc32(data[4 * start : 4 * (start + length)])
                    for name, value in zip(PIECES.names, (row, start, length, crc, total), strict=True):
                        out[name].append(value)
            yield batches(out, PIECES)

    return run


def combinations(counts: np.ndarray, window: int, partners: int = 8) -> list[tuple[int, ...]]:
    """Shallow combinations of present lengths that fill the window: all pairs, and triples with one of the most frequent lengths."""
    there = set(np.flatnonzero(counts).tolist())
    often = sorted(sorted(there, key=lambda n: (-counts[n], n))[:partners])
    found = {tuple(sorted((a, window - a), reverse=True)) for a in there if window - a in there}
    found |= {tuple(sorted((a, b, window - a - b), reverse=True)) for a in there for b in often if window - a - b in there}
    return sorted(found)


def repeats(counts: np.ndarray, combos: list[tuple[int, ...]], sweeps: int = 30) -> np.ndarray:
    """Non-negative least squares by coordinate descent: how often to use each combination so that the lengths used come close to the histogram."""
    left, x = counts.astype(float), np.zeros(len(combos))
    uses = [np.unique(c, return_counts=True) for c in combos]
    for _ in range(sweeps):
        for k, (lengths, times) in enumerate(uses):
            step = max(-x[k], float(left[lengths] @ times) / float(times @ times))
            if step:
                x[k] += step
                left[lengths] -= step * times
    return x


def plan(counts: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, number of such sequences), using each length exactly as often as it occurs.

    The rounded solution is used as far as the lengths last; the longest rest
    is then filled up with the longest that fit, again and again.
    """
    left, made = counts.astype(np.int64).copy(), []

    def use(combo: tuple[int, ...], most: int | None = None) -> None:
        lengths, times = np.unique(combo, return_counts=True)
        n = int((left[lengths] // times).min())
        n = n if most is None else min(n, most)
        if n > 0:
            left[lengths] -= n * times
            made.append((combo, n))

    use((window,))
    combos = combinations(left[:window], window)
    solved = repeats(left[:window], combos)
    for k in np.argsort(-solved, kind="stable"):
        use(combos[k], int(round(solved[k])))
    while len(rest := np.flatnonzero(left)):
        combo, room = [int(rest[-1])], window - int(rest[-1])
        left[combo[0]] -= 1
        while room:
            fits = np.flatnonzero(left[: room + 1])
            if not len(fits):
                break
            # The rest exactly, by one piece or by two; else the longest piece that fits.
            whole = fits[(left[room - fits] > (fits * 2 == room)) & (fits < room)]
            best = room if fits[-1] == room else int(whole[-1]) if len(whole) else int(fits[-1])
            combo.append(best)
            left[best] -= 1
            room -= best
        np.add.at(left, combo, 1)
        use(tuple(combo))
    return made


def pack(docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", added: bool = False) -> DataFrame:
    """Token ids of all documents, each with an end id 0, in sequences of at most ``window`` ids.

    Whole windows of a document are sequences of their own. What remains is
    shorter than a window, so a histogram of ``window`` counts describes all of
    it; combinations of lengths that fill a window are enumerated, their repeat
    counts solved by non-negative least squares against the histogram and
    rounded, and the rest is packed greedily. Pieces find their place by their
    rank among those of their length. With ``added``, added tokens of the tokenizer
    that stand in a text have their own ids; else they are spelled out.

    Result, one row per piece: id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset. Null text is empty and has the end id alone; null ids
    and repeated rows are packed like others; an empty table gives no rows.
    Only the two named columns are read; the id is an integer.
    """
    read = docs.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    cut = read.select(F.col("_id").cast("long").alias("_row"), "_text").mapInArrow(
        _piece_rows(vocabulary or default_vocabulary(), window, added), "_row long, start long, length long, ids_crc32 long, doc_tokens long"
    )
    pieces = staged(cut)
    counts = np.zeros(window + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # one row per length
        counts[row["length"]] = row["count"]
    first, slots, sequence = np.concatenate(([0], np.cumsum(counts)[:-1])), [], 0
    for combo, n in plan(counts, window):
        offset = 0
        for length in combo:
            slots.append((length, int(first[length]), int(first[length]) + n, sequence, offset))
            first[length] += n
            offset += length
        sequence += n
    table = docs.sparkSession.createDataFrame(slots, "_length long, _from long, _to long, _sequence long, offset long")
    ranked = numbered(pieces, ["length", "_row", "start", "ids_crc32"], "_rank")
    at = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    # The table has a few slots per combination, so its size depends on the window alone.
    placed = ranked.join(F.broadcast(table), at)
    return placed.select(
        F.col("_row").alias(id_col), "start", "length", "ids_crc32", "doc_tokens",
        (F.col("_sequence") + F.col("_rank") - F.col("_from")).alias("sequence_id"), "offset",
    )
