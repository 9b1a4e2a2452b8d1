"""Benchmark passages in documents, also reordered, by greedy string tiling."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shingle_hashes, texts_of, with_text

WORDS = 5
COVERAGE = 0.8
BLOCK_BYTES = 16 * 1024 * 1024
_EDGES = ".,;:!?\"'()[]{}|«»„“”‘’…-–—*"
_BASE = 0x9E3779B97F4A7C15


def words(text: str | None) -> np.ndarray:
    """Hashes of the words of a text in lower case, without punctuation at their ends."""
    found = [w for w in (w.strip(_EDGES) for w in (text or "").lower().split()) if w]
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def _windows(tokens: np.ndarray, free: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Karp-Rabin hashes of all windows of ``size`` free tokens, and where they start."""
    n = len(tokens) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    up, down = (np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(len(tokens), b, np.uint64)))) for b in (_BASE, pow(_BASE, -1, 2**64)))
    prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(tokens * up[:-1], dtype=np.uint64)))
    # Dividing by the power of its start makes equal windows equal wherever they are.
    hashes = (prefix[size:] - prefix[:n]) * down[:n]
    taken = np.concatenate(([0], np.cumsum(~free)))
    starts = np.flatnonzero(taken[size:] == taken[:n])
    return hashes[starts], starts


def tiles(doc: np.ndarray, item: np.ndarray, least: int = WORDS) -> list[tuple[int, int, int]]:
    """Greedy tiles (start in doc, start in item, length): longest common runs first, no token in two tiles, none shorter than ``least``.

    Windows of the current search length are matched by their rolling hashes,
    matches are extended over free tokens and marked longest first; then the
    search length is halved.
    """
    least = max(1, min(least, len(item)))
    free, open_, found = np.ones(len(doc), bool), np.ones(len(item), bool), []
    size = max(least, len(item))
    while True:
        hashes, starts = _windows(item, open_, size)
        index = defaultdict(list)
        for h, j in zip(hashes.tolist(), starts.tolist(), strict=True):
            index[h].append(j)
        own, places = _windows(doc, free, size)
        hit = np.isin(own, hashes) if len(hashes) else np.zeros(len(own), bool)
        seen, matches = set(), []
        for h, i in zip(own[hit].tolist(), places[hit].tolist(), strict=True):
            for j in index[h]:
                if (i - 1, j - 1) in seen:  # inside the match that began before it
                    seen.add((i, j))
                    continue
                n = 0
                while i + n < len(doc) and j + n < len(item) and free[i + n] and open_[j + n] and doc[i + n] == item[j + n]:
                    n += 1
                if n >= size:
                    matches.append((-n, i, j))
                    seen.add((i, j))
        cut = False
        for n, i, j in sorted(matches):
            n = -n
            if free[i : i + n].all() and open_[j : j + n].all():
                free[i : i + n] = open_[j : j + n] = False
                found.append((i, j, n))
            else:
                cut = True  # what is left of it is found again
        if not cut:
            if size == least:
                return sorted(found)
            size = max(least, size // 2)


class Items:
    """Benchmark items of one block, with an index of their seeds."""

    def __init__(self, rows: list[tuple[int, str | None]], least: int):
        known = [(k, words(t)) for k, t in rows if k is not None]
        self.ids = [k for k, t in known if len(t)]
        self.tokens = [t for _, t in known if len(t)]
        self.least = least
        # Items shorter than a seed are one seed of their own length.
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        sizes = np.array([min(least, len(t)) for t in self.tokens], np.int64)
        for size in sorted(set(sizes.tolist())):
            chosen = np.flatnonzero(sizes == size).tolist()
            seeds = [shingle_hashes(self.tokens[n], size) for n in chosen]
            flat, of = np.concatenate(seeds), np.repeat(chosen, [len(s) for s in seeds])
            at, order = np.concatenate([np.arange(len(s)) for s in seeds]), np.argsort(flat, kind="stable")
            self.by_size[size] = flat[order], of[order], at[order]

    def candidates(self, doc: np.ndarray, coverage: float) -> list[int]:
        """Items of which shared seeds cover enough words; tiles are made of shared seeds, so no other can pass."""
        out = []
        for size, (seeds, of, at) in self.by_size.items():
            if len(doc) < size:
                continue
            own = shingle_hashes(doc, size)
            own = np.unique(own[seeds[np.minimum(np.searchsorted(seeds, own), len(seeds) - 1)] == own])
            low, high = np.searchsorted(seeds, own), np.searchsorted(seeds, own, side="right")
            picks = [np.arange(a, b) for a, b in zip(low.tolist(), high.tolist(), strict=True)]
            if not picks:
                continue
            picked = np.concatenate(picks)
            for n in np.unique(of[picked]).tolist():
                covered = np.zeros(len(self.tokens[n]), bool)
                for j in at[picked[of[picked] == n]].tolist():
                    covered[j : j + size] = True
                if covered.sum() >= coverage * len(covered):
                    out.append(n)
        return sorted(out)

    def best(self, doc: np.ndarray, coverage: float) -> list[tuple[float, int]]:
        """(covered share, item id) of items whose tiles cover enough of their words."""
        shares = ((sum(n for _, _, n in tiles(doc, self.tokens[k], self.least)) / len(self.tokens[k]), self.ids[k]) for k in self.candidates(doc, coverage))
        return [s for s in shares if s[0] >= coverage]


def _pass(items: Items, coverage: float, keep: list[str], text_col: str):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            place = part.schema.get_field_index
            olds = zip(*(part.column(place(n)).to_pylist() for n in ("_item", "_share", "_items")), strict=True)
            new = []
            for text, (item, share, n) in zip(texts_of(part, keep, text_col), olds, strict=True):
                found = items.best(words(text), coverage)
                top = min([(-s, k) for s, k in found] + ([(-share, item)] if n else []), default=(0.0, None))
                new.append((top[1], -top[0], n + len(found)))
            names = [n for n in part.schema.names if n in ("_doc", "_text")]
            columns = [part.column(place(n)) for n in names]
            columns += [pa.array([x[k] for x in new], t) for k, t in enumerate((pa.int64(), pa.float64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "_item", "_share", "_items"])

    return run


def contamination(
    docs: DataFrame, benchmark: DataFrame, keep: list[str], least: int = WORDS, coverage: float = COVERAGE, text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The columns ``keep`` of ``docs`` as struct ``_doc``, with the item whose words the document covers most.

    Adds ``_item`` (smallest id of the best), ``_share`` (share of its words in
    tiles), ``_items`` (number of items covered by ``coverage`` or more); null, 0
    and 0 for a clean document. Tiles have at least ``least`` words, or all of a
    shorter item, and may lie in any order. The benchmark is the query set: it
    is cut by a hash into blocks of about ``block_bytes``, each of which is
    broadcast and compared with all documents in one pass without a shuffle.
    Null or empty texts and items match nothing; items without id are skipped;
    repeated rows are judged alike; an empty table gives no rows.
    """
    size = benchmark.agg(F.sum(F.octet_length(f"`{item_text}`"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    none = [F.lit(None).cast("long").alias("_item"), F.lit(0.0).alias("_share"), F.lit(0).cast("long").alias("_items")]
    rows = with_text(docs, keep, text_col).select("*", *none)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    keyed = benchmark.select(F.col(f"`{item_col}`").cast("long").alias("id"), F.col(f"`{item_text}`").alias("text"))
    for b in range(blocks):
        mine = keyed.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()  # a block of bounded size
        items = Items([tuple(r) for r in mine], least)  # goes out with the function, as one broadcast
        rows = rows.mapInArrow(_pass(items, coverage, keep, text_col), schema)
    return rows


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Documents that cover no benchmark item, with their columns as they are."""
    return contamination(docs, benchmark, docs.columns, **options).where("_items = 0").select("_doc.*")
