import hashlib
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

import siteledger.llm.word_repeats as module
from siteledger.llm.word_repeats import Run, remove_repeated_words


def plain(rows, window=13):
    """Every window against the first document that has it."""
    last, first, words = 1 << 63, {}, []
    for d, t in rows:
        own = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        words.append(own)
        for i in range(len(own) - window + 1):
            key, doc = tuple(own[i : i + window]), last if d is None else d
            first[key] = min(first.get(key, doc), doc)
    out = []
    for (d, _), own in zip(rows, words):
        gone = set()
        for i in range(len(own) - window + 1):
            if (last if d is None else d) > first[tuple(own[i : i + window])]:
                gone |= set(range(i, i + window))
        left = [w for i, w in enumerate(own) if i not in gone]
        out.append((d, len(own), len(gone), hashlib.sha256(" ".join(left).encode()).hexdigest(), " ".join(left)))
    return sorted(out, key=repr)


def run(frame, rows, **options):
    return sorted((tuple(r) for r in remove_repeated_words(frame(rows), with_text=True, **options).collect()), key=repr)


def passages(seed, docs=120, vocabulary=12):
    """Documents put together of shared passages with shifts and edits, few different words."""
    rng = np.random.default_rng(seed)
    word = lambda n: [f"w{i}" for i in rng.integers(0, vocabulary, n)]
    pool, rows = [word(int(n)) for n in rng.integers(8, 60, 25)], []
    for d in range(docs):
        own = []
        for _ in range(rng.integers(0, 5)):
            piece = list(pool[rng.integers(len(pool))])
            if piece and rng.random() < 0.3:
                piece[rng.integers(len(piece))] = "X"
            own += word(int(rng.integers(0, 9))) + piece
        rows.append((d, ("\t" if d % 3 else " \n").join(own)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_every_window(frame, seed):
    rows = passages(seed)
    assert run(frame, rows) == plain(rows)


@pytest.mark.parametrize("window", [2, 5, 8])
def test_other_windows(frame, window):
    rows = passages(9, docs=40, vocabulary=40)
    assert run(frame, rows, window=window) == plain(rows, window)


def test_nulls_repeats_ties_case_and_odd_blanks(frame):
    text = " ".join(f"v{i}" for i in range(30))
    rows = [(3, text), (3, text), (3, "a " + text), (None, text), (None, text), (9, text.upper()), (8, text.upper()), (4, None), (5, ""), (6, " \t\x0b\x0c\r\n")]
    rows += [(7, text.replace(" ", " ")), (1, text[:40]), (20, text.replace(" ", " \x0b ")), (21, "é ß 漢 " * 20), (22, "ß 漢 é " * 20), (23, "same " * 50)]
    assert run(frame, rows) == plain(rows)


def test_a_window_that_repeats_in_its_own_document_alone_stays(frame):
    text = " ".join(f"v{i}" for i in range(20))
    assert [r[2] for r in run(frame, [(1, f"{text} {text}"), (2, f"x {text} {text}")])] == [0, 40]


def test_every_shift_of_the_blocks(frame):
    text = " ".join(f"v{i}" for i in range(13))
    rows = [(i, " ".join([f"p{i}x{k}" for k in range(i)] + [text, f"q{i}"])) for i in range(15)]
    assert [r[2] for r in run(frame, rows) if r[0]] == [13] * 14


def test_hot_block_with_many_contexts_and_copies(frame):
    phrase = " ".join(f"p{i}" for i in range(7))
    rows = [(i, " ".join([f"a{i}_{k}" for k in range(6)] + [phrase] + [f"b{i % 5}_{k}" for k in range(6)])) for i in range(300)]
    rows += [(1000 + i, "copy of one text " * 20) for i in range(300)]
    assert run(frame, rows) == plain(rows)


def test_long_texts_go_in_runs(frame, monkeypatch):
    monkeypatch.setattr(module, "SLICE_WORDS", 64)
    monkeypatch.setattr(module, "SLICE_BYTES", 300)
    rows = passages(4, docs=60) + [(100, " ".join(f"u{i % 700}" for i in range(5000))), (101, " ".join(f"u{i % 700}" for i in range(300, 4000)))]
    assert run(frame, rows) == plain(rows)


def test_a_large_batch_takes_little_memory():
    words = np.array([f"w{i}" for i in range(5000)])
    rng = np.random.default_rng(5)
    texts = [" ".join(words[rng.integers(0, 5000, 300)]) for _ in range(5000)]
    part = pa.RecordBatch.from_arrays([pa.array(range(5000)), pa.array([0] * 5000), pa.array(texts)], names=["_doc", "_t", "_text"])
    full = np.full(1 << 23, 255, np.uint8)
    for function in (module._least_rows(13), module._probe_rows(13, full), module._window_rows(13, full, full), module._window_rows(13, full, full, full)):
        list(function(iter([part.slice(0, 5)])))  # constants
        tracemalloc.start()
        assert sum(len(found) for found in function(iter([part]))) > 300_000
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 24 << 20


def test_empty_table(frame):
    assert run(frame, []) == []


def test_runs_shorter_than_a_window():
    words = np.arange(5, dtype=np.uint64)
    short = Run(words, np.zeros(5, np.int64), np.arange(5), 5, 13)
    assert not len(short.whole) and not len(short.least()) and not len(short.inside(short.whole))
