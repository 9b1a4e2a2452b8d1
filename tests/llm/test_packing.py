import zlib
from collections import defaultdict

import numpy as np
from public_tokenizers import path
from tokenizers import Tokenizer

from siteledger.llm.packing import Ids, default_vocabulary, pack, plan

TOKENIZER = Tokenizer.from_file(path("byte_bpe_50k.json"))
TOKENIZER.encode_special_tokens = True


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, docs, window):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(docs)
    for doc, own in pieces.items():
        ids, at = ids_of(docs[doc]), 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : at], "<u4").tobytes())
        assert at == len(ids)
    total = 0
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= window
        total += at
    return total / (len(sequences) * window)


def test_whole_table(corpus, texts):
    rows = pack(corpus).collect()
    assert check(rows, texts, 1024) > 0.97
    assert {r["sequence_id"] for r in rows} == set(range(len({r["sequence_id"] for r in rows})))


def test_odd_texts(frame):
    odd = [None, "", " ", "  a  b ", "a\n b", "\n\n", "don't I'll", "x" * 3000, "été 123 45 é  z", "<|endoftext|>", "a \tb", "a\x1cb c", "日本語 テキスト 😀 " * 400]
    docs = dict(enumerate(odd))
    check(pack(frame(list(docs.items())), window=64).collect(), docs, 64)
    assert pack(frame([])).count() == 0


def test_repeated_rows_and_null_ids(frame):
    rows = pack(frame([(1, "a b c"), (1, "a b c"), (None, "d")])).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in rows) == [(0, 2), (1, 4), (1, 4)]


def test_ids_equal_the_tokenizer_on_the_table(texts):
    words = Ids(default_vocabulary())
    for text in texts.values():
        assert np.frombuffer(words.of(text), "<u4").tolist() == ids_of(text)[:-1]


def first_fit(counts, window):
    """Number of bins of first fit, longest first."""
    room = []
    for length in np.repeat(np.arange(len(counts)), counts)[::-1].tolist():
        k = next((k for k, r in enumerate(room) if r >= length), None)
        if k is None:
            room.append(window - length)
        else:
            room[k] -= length
    return len(room)


def test_plan_uses_every_length_once_and_packs_as_well_as_first_fit():
    for seed in range(5):
        counts = np.random.default_rng(seed).integers(0, 20 if seed else 1, 101)
        counts[0] = 0
        used, made = np.zeros_like(counts), 0
        for combo, n in plan(counts, 100):
            assert sum(combo) <= 100
            np.add.at(used, list(combo), n)
            made += n
        assert (used == counts).all() and made <= 1.03 * first_fit(counts, 100)
