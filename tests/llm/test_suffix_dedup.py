import hashlib
import random

import numpy as np
import pytest

from siteledger.llm.suffix_dedup import earlier, remove_repeats


def plain(rows, least):
    """Bytes covered by windows that start earlier, document by document."""
    seen, out = set(), {}
    for key, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - least + 1):
            window = data[k : k + least]
            if window in seen:
                gone[k : k + least] = b"\1" * least
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[key] = (len(data), len(data) - len(kept), runs, hashlib.sha256(kept).hexdigest())
    return out


def got(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}


@pytest.mark.parametrize("options", [{}, {"bucket_bytes": 2000}, {"hot_pieces": 1}])
def test_whole_table(corpus, texts, options):
    assert got(remove_repeats(corpus, **options)) == plain(sorted(texts.items()), 100)


def test_expansion_finds_what_plain_search_finds():
    for seed in range(40):
        rnd = random.Random(seed)
        least, texts = rnd.choice([3, 5, 8]), [bytes(rnd.choice(b"ab\0\xff"[: rnd.choice([1, 2, 4])]) for _ in range(rnd.randint(0, 40))) for _ in range(rnd.randint(1, 12))]
        doc, start = np.array([rnd.randint(0, 3) for _ in texts]), np.arange(len(texts)) * 1000
        text, first, last = earlier(texts, doc, np.zeros(len(texts), int), start, least)
        seen, want = set(), set()
        for _, i, k in sorted(((doc[i], start[i] + k), i, k) for i, t in enumerate(texts) for k in range(len(t) - least + 1)):
            if texts[i][k : k + least] in seen:
                want.add((i, k))
            seen.add(texts[i][k : k + least])
        assert {(i, k) for i, a, b in zip(text.tolist(), first.tolist(), last.tolist(), strict=True) for k in range(a, b + 1)} == want


def test_periodic_texts_hot_passages_and_small_texts(frame):
    rnd = random.Random(2)
    passage = " ".join(rnd.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(60))
    rows = [(i, f"{rnd.random()} {passage} {rnd.random()}") for i in range(60)]
    rows += [(100, "a" * 5000), (101, "ab" * 3000), (102, "abc" * 400 + "é" * 300), (103, None), (104, ""), (105, "x" * 99), (106, "x" * 100), (107, "x" * 101), (108, passage[:99])]
    for options in ({}, {"hot_pieces": 5}):
        assert got(remove_repeats(frame(rows), **options)) == plain(rows, 100)


def test_long_text_across_chunks(frame):
    rnd = random.Random(3)
    unit = " ".join(f"word{rnd.randrange(10**6)}" for _ in range(60_000))
    rows = [(1, unit + unit[:700_000]), (2, "front " + unit[5000:])]
    assert got(remove_repeats(frame(rows))) == plain(rows, 100)


def test_repeated_ids_null_ids_and_empty_tables(frame):
    text = "some words that are long enough to be found again " * 4 + "end"
    rows = remove_repeats(frame([(None, text), (1, text), (1, text), (1, "other " + text)])).collect()
    assert len(rows) == 4
    last = [r for r in rows if r["doc_id"] is None][0]
    assert last["n_removed"] == last["n_bytes"]  # a null id is last
    same = [r["n_removed"] for r in rows if r["n_bytes"] == len(text) and r["doc_id"] == 1]
    assert len(set(same)) == 1
    assert remove_repeats(frame([])).count() == 0


def test_text_that_is_left(frame):
    text = " ".join(f"w{k}" for k in range(80))
    left = {r["doc_id"]: r["kept"] for r in remove_repeats(frame([(1, text), (2, "own " + text)]), with_text=True).collect()}
    assert left[1].decode() == text and left[2].decode() == "own "
