import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from siteledger.llm.common import fold
from siteledger.llm.lm_score import MASS, EliasFano, learn_model, score_documents, score_with


def plain(rows):
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    docs = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    words, pairs, starts = Counter(), Counter(), 0
    for h, d in zip(held, docs, strict=True):
        if not h:
            words.update(d)
            pairs.update(zip(["start", *d[:-1]], d, strict=True))
            starts += 1
    total, distinct = sum(words.values()), len(words)
    out = []
    for (i, _), h, d in zip(rows, held, docs, strict=True):
        share = [(words[w] + 1) / (total + distinct + 1) for w in d]
        before = [starts, *(words[w] for w in d[:-1])]
        score = sum(math.log10((pairs[p] + MASS * s) / (b + MASS)) for p, s, b in zip(zip(["start", *d[:-1]], d, strict=True), share, before, strict=True))
        out.append((i, h, len(d), sum(w in words for w in d), total, sum(map(math.log10, share)), score))
    return out


def check(docs, rows):
    got = sorted(map(tuple, score_documents(docs, fold("doc_id", 7) == 2, shard_bytes=20_000).collect()), key=str)
    want = sorted(plain(rows), key=str)
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=lambda r: (str(r[0]), r[2], r[5])), sorted(want, key=lambda r: (str(r[0]), r[2], r[5])), strict=True):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-4, abs=1e-3)


def test_whole_table(corpus, texts):
    check(corpus, list(texts.items()))


def test_odd_texts_hot_words_and_repeats(frame):
    rows = [(i, "hot hot hot " * (i % 9) + f"w{i % 40} v{i % 7}") for i in range(300)]
    rows += [(500, None), (501, ""), (502, "\n"), (503, "hot pair " * 40000), (None, "hot w1"), (504, "x" * 3_000_000 + " hot"), (7, "hot again"), (7, "hot again")]
    check(frame(rows), rows)


def test_empty_table_and_nothing_to_learn(frame):
    assert score_documents(frame([]), F.lit(False)).count() == 0
    row = score_documents(frame([(1, "a b")]), F.lit(True)).collect()[0]
    assert (row["train_tokens"], row["n_known"], row["n_tokens"]) == (0, 0, 3) and row["base_score"] == 0


def test_model_beats_the_base_on_held_out_texts(corpus):
    total = score_documents(corpus, fold("doc_id", 7) == 2).where("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert total[1] > total[0]


def test_elias_fano_successor(tmp_path):
    rnd = np.random.default_rng(1)
    for n, universe in ((0, 10), (1, 1), (5, 6), (100, 120), (1000, 1 << 40), (1000, 5000), (3000, 1 << 62)):
        values = np.sort(rnd.integers(0, universe, n).astype(np.uint64))
        coded = EliasFano(values, universe).store(str(tmp_path), f"{n}-{universe}")
        asked = np.concatenate((values, rnd.integers(0, universe, 500).astype(np.uint64)))
        place, found = coded.successor(asked)
        assert (found == np.isin(asked, values)).all()
        assert (place[found] == np.searchsorted(values, asked[found])).all()


def test_scores_come_from_stored_tries_alone(spark, corpus, texts, frame):
    """Learnt once, then asked about other texts; the tries are a stored table and nothing else is kept of the corpus."""
    model = learn_model(corpus, F.lit(False), shard_bytes=20_000)
    rows = list(texts.items())
    other = [(i, " ".join(reversed((t or "").split()))) for i, t in rows[:40]] + [(10**6, "never seen words only"), (10**6 + 1, None)]
    words, pairs = Counter(), Counter()
    for _, t in rows:
        d = [*(t or "").encode().lower().split(), None]
        words.update(d)
        pairs.update(zip(["start", *d[:-1]], d, strict=True))
    got = {r["doc_id"]: r for r in score_with(frame(other), model, F.lit(True)).collect()}
    assert len(got) == len(other)
    total = sum(words.values()) + len(words) + 1
    for i, t in other:
        d = [*(t or "").encode().lower().split(), None]
        before = [len(rows), *(words[w] for w in d[:-1])]
        share = [(words[w] + 1) / total for w in d]
        want = sum(math.log10((pairs[p] + MASS * s) / (c + MASS)) for p, s, c in zip(zip(["start", *d[:-1]], d, strict=True), share, before, strict=True))
        assert got[i]["score"] == pytest.approx(want, rel=1e-4, abs=1e-3)
    tries = spark.read.parquet(*model.tries.inputFiles())
    assert tries.count() > 10 and tries.select("shard").distinct().count() == tries.count()


def test_pairs_of_frequent_words_are_in_many_tries(frame):
    rows = [(i, " ".join(f"hot w{(i * 31 + k) % 5000}" for k in range(50))) for i in range(400)]
    model = learn_model(frame(rows), F.lit(False), shard_bytes=4_000)
    sizes = [len(r["levels"]) for r in model.tries.collect()]
    assert len(sizes) > 20 and max(sizes) < 6 * sorted(sizes)[len(sizes) // 2]
    check_rows = {r["doc_id"]: r["score"] for r in score_with(frame(rows), model, F.lit(False)).collect()}
    assert len(check_rows) == 400 and all(s < 0 for s in check_rows.values())


def test_elias_fano_values_at_places():
    rnd = np.random.default_rng(2)
    for n, universe in ((1, 1), (5, 6), (100, 120), (1000, 1 << 40), (1000, 5000), (3000, 1 << 62), (2000, 1 << 50)):
        values = np.sort(rnd.integers(0, universe, n).astype(np.uint64))
        places = rnd.integers(0, n, 700)
        assert (EliasFano(values, universe).at(places) == values[places]).all()
