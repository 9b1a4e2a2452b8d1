"""Language-model scores from stored n-gram tries whose levels are Elias-Fano coded and memory-mapped."""

from __future__ import annotations

import math
import os
import struct
import tempfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteledger.operators import staged

from .common import release, text_bytes, token_hashes, unstage

END = np.uint64(1)
MASS = 100.0
LEAST_SHARE, MOST_SHARE = 1000, 100_000
SHARD_BYTES = 8 << 20
SLICE_BYTES = 4 << 20
SLICE_TEXTS = 1 << 16
NODE_BITS, CHILD_BITS = np.uint64(48), np.uint64(40)
_BLOCKS = pa.schema([("shard", pa.int64()), ("part", pa.int64()), ("data", pa.binary())])
_BLOCK_TYPE = "shard long, part long, data binary"
_TRIES = pa.schema([("shard", pa.int64()), ("levels", pa.binary())])
_TRIE_TYPE = "shard long, levels binary"


def _dump(*arrays: np.ndarray) -> bytes:
    """Arrays one after the other, each behind its type and length, at multiples of eight bytes."""
    out = []
    for a in arrays:
        out += [struct.pack("<cxxxI", a.dtype.char.encode(), len(a)), np.ascontiguousarray(a).tobytes(), bytes(-a.nbytes % 8)]
    return b"".join(out)


def _load(data: np.ndarray) -> list[np.ndarray]:
    """The arrays of a dump, as views of its bytes."""
    arrays, at = [], 0
    while at < len(data):
        kind, n = struct.unpack("<cxxxI", data[at : at + 8].tobytes())
        size = n * np.dtype(kind.decode()).itemsize
        arrays.append(data[at + 8 : at + 8 + size].view(kind.decode()))
        at += 8 + size + -size % 8
    return arrays


def _bytes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8)


def _packed(data: bytes) -> bytes:
    """Entropy-coded bytes behind their length, for what is shuffled or stored."""
    return struct.pack("<Q", len(data)) + pa.compress(data, "zstd", asbytes=True)


def _unpacked(data: bytes) -> bytes:
    return pa.decompress(data[8:], struct.unpack_from("<Q", data)[0], "zstd", asbytes=True)


def _mapped(data: bytes, folder: str, name: str) -> list[np.ndarray]:
    """The arrays of a dump, in a file that is mapped instead of held."""
    path = os.path.join(folder, name)
    with open(path, "wb") as file:
        file.write(data)
    return _load(np.memmap(path, np.uint8, "r")) if data else []


def _select(words: np.ndarray, before: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th set bit, counted from 1; ``before`` counts the set bits in front of each word."""
    word = np.maximum(np.searchsorted(before, k, side="left") - 1, 0)
    rest = k - before[word]
    bits, place = words[word], np.zeros(len(k), np.int64)
    for half in (32, 16, 8, 4, 2, 1):
        inside = np.bitwise_count(bits & ((np.uint64(1) << np.uint64(half)) - np.uint64(1))).astype(np.int64)
        right = inside < rest
        rest = np.where(right, rest - inside, rest)
        place += np.where(right, half, 0)
        bits = np.where(right, bits >> np.uint64(half), bits)
    return word * 64 + place


class _Flipped:
    """Words of a bit sequence with every bit turned over, read as they are asked for."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return ~self.words[at]


class EliasFano:
    """A monotone sequence: low bits as they are, high parts in unary with a count of zeros per word.

    Low bits lie in planes of 32 and 8 bits (or 32 more), so that 40 bits take five bytes.
    """

    def __init__(self, values: np.ndarray, universe: int):
        n = len(values)
        shift = max(0, (universe // max(1, n)).bit_length() - 1)
        low = values & np.uint64((1 << shift) - 1)
        first = next(t for t in (np.uint8, np.uint16, np.uint32) if min(shift, 32) <= np.dtype(t).itemsize * 8)
        rest = np.uint8 if shift <= 40 else np.uint32
        upper = (low >> np.uint64(32)).astype(rest) if shift > 32 else np.zeros(0, rest)
        high = (values >> np.uint64(shift)).astype(np.int64)
        bits = np.zeros(-(-(n + (universe >> shift) + 2) // 64) * 64, np.uint8)
        bits[high + np.arange(n)] = 1
        words = np.packbits(bits, bitorder="little").view(np.uint64)
        zeros = np.concatenate(([0], np.cumsum(64 - np.bitwise_count(words).astype(np.int64))))
        self._set([np.array([n, shift]), low.astype(first), upper, words, zeros])

    def _set(self, parts: list[np.ndarray]) -> None:
        self.parts = parts
        size, self.low, self.upper, self.words, self.zeros = parts
        self.n, self.shift = int(size[0]), np.uint64(size[1])

    @classmethod
    def of(cls, parts: list[np.ndarray]) -> EliasFano:
        made = cls.__new__(cls)
        made._set(parts)
        return made

    def store(self, folder: str, name: str) -> EliasFano:
        """The same sequence in a file that is mapped instead of held."""
        return EliasFano.of(_mapped(_dump(*self.parts), folder, name))

    def _lows(self, places: np.ndarray) -> np.ndarray:
        low = self.low[places].astype(np.uint64)
        return low | (self.upper[places].astype(np.uint64) << np.uint64(32)) if len(self.upper) else low

    def at(self, places: np.ndarray) -> np.ndarray:
        """Values at the given places."""
        ones = np.arange(len(self.zeros)) * 64 - self.zeros
        high = _select(self.words, ones, places.astype(np.int64) + 1) - places
        return (high.astype(np.uint64) << self.shift) | self._lows(places)

    def _ones_before(self, high: np.ndarray) -> np.ndarray:
        """Number of values whose high part is below ``high``: what stands before zero number ``high``, less the zeros."""
        k = high.astype(np.int64)
        return np.where(k == 0, 0, _select(_Flipped(self.words), self.zeros, k) + 1 - k)

    def successor(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first value not below each given one, and whether it is that value."""
        high, low = values >> self.shift, values & ((np.uint64(1) << self.shift) - np.uint64(1))
        left, right = self._ones_before(high), self._ones_before(high + np.uint64(1))
        stop, last = right.copy(), max(self.n - 1, 0)
        while self.n and (left < right).any():
            middle = (left + right) // 2
            less = (left < right) & (self._lows(np.minimum(middle, last)) < low)
            left, right = np.where(less, middle + 1, left), np.where(less | (left >= right), right, middle)
        found = left < stop
        return left, found & (self._lows(np.minimum(left, last)) == low) if self.n else found


class Trie:
    """Contexts, and under each the words that follow it, with two bytes per pair for its probability.

    Four monotone sequences: the contexts, where the children of each begin, how
    many tokens that teach have come up to each, and all children, each relative to
    its context, whose rank is the high part. Log probabilities are quantised to
    even steps; code 0 stands for a pair that is not there.
    """

    LEVELS = 4

    def __init__(self, arrays: list[np.ndarray]):
        parts = [EliasFano.of(arrays[5 * k : 5 * k + 5]) for k in range(self.LEVELS)]
        self.nodes, self.starts, self.totals, self.children = parts
        self.codes, self.scale = arrays[5 * self.LEVELS :]

    @staticmethod
    def levels(nodes: np.ndarray, owners: np.ndarray, children: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> bytes:
        """The levels as bytes: sorted contexts, and per pair its context's rank, child, count and log probability."""
        starts = np.concatenate(([0], np.cumsum(np.bincount(owners, minlength=len(nodes)))))
        totals = np.concatenate(([0], np.cumsum(np.bincount(owners, counts, len(nodes)).astype(np.int64))))
        least, most = (float(weights.min()), float(weights.max())) if len(weights) else (0.0, 0.0)
        step = (most - least) / 65534 or 1.0
        coded = [
            EliasFano(nodes, 1 << int(NODE_BITS)),
            EliasFano(starts.astype(np.uint64), len(owners) + 1),
            EliasFano(totals.astype(np.uint64), int(totals[-1]) + 1),
            EliasFano((owners.astype(np.uint64) << CHILD_BITS) | children, max(1, len(nodes)) << int(CHILD_BITS)),
        ]
        codes = (np.rint((weights - least) / step) + 1).astype(np.uint16)
        return _dump(*(a for level in coded for a in level.parts), codes, np.array([least, step]))

    def find(self, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each context (0 if it is not there), and tokens that teach below it here."""
        place, found = self.nodes.successor(contexts)
        rank = np.where(found, place, 0)
        total = (self.totals.at(rank + 1) - self.totals.at(rank)).astype(np.int64) if self.nodes.n else np.zeros(len(rank), np.int64)
        return np.where(found, rank, -1), np.where(found, total, 0)

    def look_up(self, ranks: np.ndarray, owners: np.ndarray, children: np.ndarray) -> np.ndarray:
        """Code of each (context by its place in ``ranks``, child); 0 where it has no such child."""
        codes = np.zeros(len(owners), np.uint16)
        asked = np.flatnonzero(ranks[owners] >= 0)
        if len(asked):
            begin, stop = self.starts.at(np.maximum(ranks, 0)), self.starts.at(np.maximum(ranks, 0) + 1)
            of = owners[asked]
            place, found = self.children.successor((ranks[of].astype(np.uint64) << CHILD_BITS) | children[asked])
            found &= (place >= begin[of].astype(np.int64)) & (place < stop[of].astype(np.int64))
            codes[asked[found]] = self.codes[place[found]]
        return codes


@dataclass
class Known:
    """What every task knows of the corpus: totals, and the frequent words with their counts, at most ``MOST_SHARE`` and the end."""

    tokens: int
    distinct: int
    hot: np.ndarray
    counts: np.ndarray
    shards: int
    mass: float

    @property
    def total(self) -> int:
        return self.tokens + self.distinct + 1


@dataclass
class Model:
    """Stored tries, one row per shard, and what every task knows."""

    tries: DataFrame
    known: Known


def _nodes(hashes: np.ndarray) -> np.ndarray:
    """48 bits of a hash, for the contexts of one shard."""
    return (hashes * np.uint64(0xBF58476D1CE4E5B9)) >> (np.uint64(64) - NODE_BITS)


def _children(hashes: np.ndarray) -> np.ndarray:
    """40 bits of a hash, for the words after one context."""
    return (hashes * np.uint64(0xD6E8FEB86659FD93)) >> (np.uint64(64) - CHILD_BITS)


def _planes(values: np.ndarray, upper: type) -> list[np.ndarray]:
    """The low 32 bits of numbers, and the rest in a type of its own."""
    return [values.astype(np.uint32), (values >> np.uint64(32)).astype(upper)]


def _whole(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
    return lower.astype(np.uint64) | (upper.astype(np.uint64) << np.uint64(32))


def _shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((((hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) * np.uint64(shards)) >> np.uint64(24)).astype(np.int64)


def _least(values: np.ndarray) -> np.ndarray:
    """Counts in the smallest type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))


def _slices(part: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of texts of a batch of bounded size: (rows, word hashes, texts of words)."""
    data, ends = text_bytes(part.column(part.schema.get_field_index("_text")))
    begin = 0
    while begin < len(part):
        stop = int(np.searchsorted(ends, ends[begin] + SLICE_BYTES, side="right")) - 1
        stop = min(max(stop, begin + 1), begin + SLICE_TEXTS, len(part))
        hashes, texts = token_hashes(data[ends[begin] : ends[stop]], ends[begin : stop + 1] - ends[begin])
        yield part.slice(begin, stop - begin), hashes, texts
        begin = stop


def _flags(rows: pa.RecordBatch) -> np.ndarray:
    return rows.column(rows.schema.get_field_index("_held")).to_numpy(zero_copy_only=False)


def _count_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        for rows, hashes, texts in _slices(part):
            learn = ~_flags(rows)
            words, n = np.unique(hashes[learn[texts]], return_counts=True)
            words, n = np.append(words, END), np.append(n, learn.sum())
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])


class Slice:
    """Tokens of a run of texts as numbers of its distinct words, which are sorted by their shards."""

    def __init__(self, hashes: np.ndarray, texts: np.ndarray, n: int, known: Known):
        now = np.full(len(hashes) + n, END)
        now[np.arange(len(hashes)) + texts] = hashes
        words, slots = np.unique(now, return_inverse=True)
        order = np.argsort(_shard(words, known.shards), kind="stable")
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        self.words, self.slots = words[order], place[slots]
        self.lengths = np.bincount(texts, minlength=n) + 1
        self.shard = _shard(self.words, known.shards)
        at = np.minimum(np.searchsorted(known.hot, self.words), len(known.hot) - 1)
        self.hot = known.hot[at] == self.words
        self.counts = np.where(self.hot, known.counts[at], 0)


def _pairs(slots: np.ndarray, end: int, shard: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct pairs (context, word) by the shards they are dealt to, each pair's shard, where contexts begin, and the pair of every token.

    A pair goes to its context's shard, and to its word's shard if the context is
    a frequent word. The end of a text is the context of the next text's first word.
    """
    before = np.concatenate((np.full(min(1, len(slots)), end), slots[:-1]))
    keys, of = np.unique(before * len(shard) + slots, return_inverse=True)
    a, b = keys // max(1, len(shard)), keys % max(1, len(shard))
    dealt = np.where(hot[a], shard[b], shard[a])
    order = np.argsort(dealt, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    a, b, dealt = a[order], b[order], dealt[order]
    new = np.concatenate((np.ones(min(1, len(a)), bool), (a[1:] != a[:-1]) | (dealt[1:] != dealt[:-1])))
    return a, b, dealt, np.flatnonzero(new), place[of]


def _blocks(words: np.ndarray, a: np.ndarray, b: np.ndarray, dealt: np.ndarray, starts: np.ndarray, counts: np.ndarray | None) -> Iterator[tuple[int, bytes]]:
    """Per shard its contexts, their numbers of children, the children, and counts if there are any."""
    contexts, per, child = _nodes(words[a[starts]]), np.diff(np.append(starts, len(a))), _children(words[b])
    shards, first = np.unique(dealt, return_index=True)
    bounds = np.append(first, len(a))
    of = np.searchsorted(starts, bounds)
    for k, s in enumerate(shards.tolist()):
        mine, here = slice(of[k], of[k + 1]), slice(bounds[k], bounds[k + 1])
        more = [] if counts is None else [_least(counts[here])]
        yield s, _dump(*_planes(contexts[mine], np.uint16), _least(per[mine]), *_planes(child[here], np.uint8), *more)


def _rows(out: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(schema)], schema=schema)


def _learn_rows(known: Known):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for rows, hashes, texts in _slices(part):
                learn = ~_flags(rows)
                kept = np.cumsum(learn) - 1
                mine = learn[texts]
                words = Slice(hashes[mine], kept[texts[mine]], int(learn.sum()), known)
                if len(words.slots):
                    a, b, dealt, starts, of = _pairs(words.slots, words.slots[-1], words.shard, words.hot)
                    yield _rows([(s, 0, d) for s, d in _blocks(words.words, a, b, dealt, starts, np.bincount(of))], _BLOCKS)

    return run


def _joined(blocks: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct contexts of blocks, per pair the rank of its context and the child, and the ranks of each block's contexts."""
    lower, upper, per, low_child, high_child = (np.concatenate([b[k] for b in blocks]) for k in range(5))
    nodes, rank = np.unique(_whole(lower, upper), return_inverse=True)
    ranks = np.split(rank, np.cumsum([len(b[0]) for b in blocks])[:-1])
    return nodes, np.repeat(rank, per), _whole(low_child, high_child), ranks


def _build_rows(known: Known):
    def run(table: pa.Table) -> pa.Table:
        """The trie of one shard from all its blocks."""
        blocks = [_load(_bytes(d)) for d in table["data"].to_pylist()]
        nodes, owner, child, _ = _joined(blocks)
        keys, entry = np.unique((owner.astype(np.uint64) << CHILD_BITS) | child, return_inverse=True)
        count = np.bincount(entry, np.concatenate([b[5] for b in blocks]))
        owner, child = (keys >> CHILD_BITS).astype(np.int64), keys & ((np.uint64(1) << CHILD_BITS) - np.uint64(1))
        hot, order = np.unique(_nodes(known.hot), return_index=True)
        at = np.minimum(np.searchsorted(hot, nodes), len(hot) - 1)
        total = np.where(hot[at] == nodes, known.counts[order[at]], np.bincount(owner, count, len(nodes)))
        levels = Trie.levels(nodes, owner, child, count, np.log10(count / (total[owner] + known.mass)))
        return pa.Table.from_batches([_rows([(table["shard"][0].as_py(), _packed(levels))], _TRIES)])

    return run


def _ask_rows(known: Known):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for part in parts:
            for rows, hashes, texts in _slices(part):
                uid, number = (task << 24) | number, number + 1
                words = Slice(hashes, texts, len(rows), known)
                a, b, dealt, starts, _ = _pairs(words.slots, words.slots[-1], words.shard, words.hot)
                ids = rows.column(rows.schema.get_field_index("_id"))
                frequent = np.flatnonzero(words.hot)
                low, high = words.slots.astype(np.uint16), _least(words.slots >> 16)
                there, runs = np.unique(words.shard, return_counts=True)
                stay = _dump(np.array(ids.fill_null(0)), np.array(ids.is_null()), _flags(rows), words.lengths, there, runs, frequent, words.counts[frequent], low, high)
                yield _rows([*((s, uid, d) for s, d in _blocks(words.words, a, b, dealt, starts, None)), (-1 - uid, uid, _packed(stay))], _BLOCKS)

    return run


def _answer_rows(asked: pa.Table, stored: pa.Table) -> pa.Table:
    """For each block the counts of its contexts and the codes of its pairs, by successor search in the shard's mapped trie.

    What a part of the texts keeps for itself has a number of its own below zero and passes.
    """
    shards, parts, data = (asked[n].to_pylist() for n in ("shard", "part", "data"))
    if not shards or shards[0] < 0:
        return asked.cast(_BLOCKS)
    blocks = [_load(_bytes(d)) for d in data]
    nodes, owner, child, ranks = _joined(blocks)
    counts, codes, scale = np.zeros(len(nodes), np.int64), np.zeros(len(owner), np.uint16), np.array([0.0, 1.0])
    if len(stored):
        with tempfile.TemporaryDirectory() as folder:
            trie = Trie(_mapped(_unpacked(stored["levels"][0].as_py()), folder, "trie"))
            rank, counts = trie.find(nodes)
            codes, scale = trie.look_up(rank, owner, child), np.array(trie.scale)
    per_block = np.split(codes, np.cumsum([len(b[3]) for b in blocks])[:-1])
    out = [(s, p, _packed(_dump(_least(counts[r]), c, scale))) for s, p, r, c in zip(shards, parts, ranks, per_block, strict=True)]
    return pa.Table.from_batches([_rows(out, _BLOCKS)])


_SCORES = pa.schema([("_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def _sum_rows(known: Known) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        """Scores of one run of texts: answers come back in the order in which their shards were asked."""
        rows = sorted(zip(table["shard"].to_pylist(), table["data"].to_pylist(), strict=True), key=lambda r: r[0])
        ids, null, held, lengths, there, runs, frequent, often, low, high = _load(_bytes(_unpacked(rows[0][1])))
        slots, shard, n = low.astype(np.int64) | (high.astype(np.int64) << 16), np.repeat(there, runs), len(ids)
        hot, counts = np.zeros(len(shard), bool), np.zeros(len(shard), np.int64)
        hot[frequent] = True
        a, b, _, starts, of = _pairs(slots, slots[-1], shard, hot)
        answers = [_load(_bytes(_unpacked(d))) for _, d in rows[1:]]
        counts[a[starts]] = np.concatenate([x[0] for x in answers])
        counts[frequent] = often
        seen = np.concatenate([np.where(c > 0, 10.0 ** (s[0] + s[1] * (c.astype(np.float64) - 1)), 0.0) for _, c, s in answers])
        share = (counts + 1) / known.total
        chance = np.log10(seen + known.mass / (counts[a] + known.mass) * share[b])
        text = np.repeat(np.arange(n), lengths)
        heard, base, score = (np.bincount(text, v, n) for v in ((counts > 0)[slots], np.log10(share)[slots], chance[of]))
        columns = [pa.array(ids, pa.int64(), mask=null), held, lengths, heard.astype(np.int64), base, score]
        return pa.Table.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, _SCORES, strict=True)], schema=_SCORES)

    return run


def _read(docs: DataFrame, held_out: Column, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"), held_out.alias("_held"))


def learn_model(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", mass: float = MASS, shard_bytes: int = SHARD_BYTES) -> Model:
    """Tries of all pairs of words in texts that are not held out, one stored row per shard.

    Words are counted first. A word is frequent if it makes up more than one in
    as many tokens as there are shards (1,000 to 100,000): its pairs are dealt by the
    word after it, so no shard holds them all, and its count goes to every task.
    Other pairs are dealt by their context. Nothing is pruned; without any text to
    learn from there are no tries.
    """
    spark, read = docs.sparkSession, _read(docs, held_out, id_col, text_col)
    size = read.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    shards = max(1, math.ceil(size / shard_bytes))
    counted = read.select("_text", "_held").mapInArrow(_count_rows, "word long, n long")
    counts = staged(counted.groupBy("word").agg(F.sum("n").alias("n")).where("n > 0"))
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    often = min(max(shards, LEAST_SHARE), MOST_SHARE)
    frequent = counts.where((F.col("n") * often > tokens) | (F.col("word") == int(END))).toArrow()  # ``often`` rows and the end at most
    unstage(counts)
    release(spark)
    table = {int(END): 0} | dict(zip(frequent["word"].to_numpy().view(np.uint64).tolist(), frequent["n"].to_pylist(), strict=True))
    hot = np.array(sorted(table), np.uint64)
    known = Known(tokens, distinct, hot, np.array([table[w] for w in hot.tolist()], np.int64), shards, mass)
    blocks = read.select("_text", "_held").mapInArrow(_learn_rows(known), _BLOCK_TYPE)
    tries = staged(blocks.groupBy("shard").applyInArrow(_build_rows(known), _TRIE_TYPE))
    release(spark)
    return Model(tries, known)


def score_with(docs: DataFrame, model: Model, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of any texts by stored tries; nothing is learnt from them. Result as that of ``score_documents``.

    Each task cuts its texts into runs of bounded size and asks the shards once per
    distinct pair of a run. A shard maps its trie, searches contexts and children, and
    answers with counts of contexts and codes of pairs; the run's own numbers of
    words, compressed, meet the answers again.
    """
    known = model.known
    sent = _read(docs, held_out, id_col, text_col).mapInArrow(_ask_rows(known), _BLOCK_TYPE)
    answers = sent.groupBy("shard").cogroup(model.tries.groupBy("shard")).applyInArrow(_answer_rows, _BLOCK_TYPE)
    scores = answers.groupBy("part").applyInArrow(_sum_rows(known), "_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scores.select(F.col("_id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(known.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def score_documents(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", mass: float = MASS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Log10 probability of every text under a bigram model of the texts that are not held out.

    Tokens are words, A to Z in lower case, and an end after each text. The
    probability of word w after v is (c(v w) + mass * u(w)) / (c(v) + mass) with the
    add-one share u(w) = (c(w) + 1) / (N + V + 1), so all words' probabilities add up
    to 1. Tries hold the quantised c(v w) / (c(v) + mass) and exact c(v); the rest
    follows from these. First ``learn_model``, then ``score_with``.

    Result: id, held_out, n_tokens, n_known, train_tokens, base_score (sum of
    log10 u), score. Null text is empty and has the end alone; a null id stays
    null; repeated rows are texts of their own; an empty table gives no rows;
    without any text to learn from all words are unknown. The id is an integer.
    """
    model = learn_model(docs, held_out, id_col, text_col, mass, shard_bytes)
    return score_with(docs, model, held_out, id_col, text_col)
