import random
from collections import Counter, defaultdict

import pytest

from siteledger.llm.minhash import drop_near, near_duplicates


def plain(rows, shingle, percent):
    sets, inverted = {}, defaultdict(list)
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + shingle]) for k in range(max(1, len(w) - shingle + 1))} if w else set()
        for s in sets[i]:
            inverted[s].append(i)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, own in sets.items():
        for j, n in Counter(j for s in own for j in inverted[s] if j > i).items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in sets)


def got(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect())


@pytest.mark.parametrize(("shingle", "percent", "small"), [(3, 85, 32), (5, 80, 2)])
def test_whole_table(corpus, texts, shingle, percent, small):
    assert got(near_duplicates(corpus, shingle, percent, small=small)) == plain(texts.items(), shingle, percent)


def chained(seed, docs):
    """Chains and crowds of near copies: each changes a few words of one before it."""
    rnd, rows = random.Random(seed), []
    words = [f"w{k}" for k in range(4000)]
    for group in range(6):
        base = [rnd.choice(words) for _ in range(60 + 40 * group)]
        for _ in range(docs):
            rows.append(" ".join(base))
            if group % 2:  # a chain
                base[rnd.randrange(len(base))] = rnd.choice(words)
            else:
                other = list(base)
                for _ in range(rnd.randint(0, 6)):
                    other[rnd.randrange(len(other))] = rnd.choice(words)
                rows[-1] = " ".join(other)
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("small", [1, 8, 1000])
def test_chains_and_large_groups(frame, small):
    rows = chained(7, 40)
    assert got(near_duplicates(frame(rows), small=small)) == plain(rows, 3, 85)


def test_odd_texts(frame):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "two words"), (7, "Two  words"), (8, "x y z " * 30000), (9, "x y z " * 20), (10, "é"), (11, "É")]
    assert got(near_duplicates(frame(rows))) == plain(rows, 3, 85)


def test_null_ids_repeats_and_empty_tables(frame):
    rows = near_duplicates(frame([(None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (None, "q r s t"), (4, "A B C D")])).collect()
    assert Counter((r["doc_id"], r["component_id"]) for r in rows) == Counter([(None, 3), (3, 3), (3, 3), (None, None), (4, 3)])
    assert near_duplicates(frame([])).count() == 0 and near_duplicates(frame([(1, None)])).collect()[0]["kept"]


def test_dropping_keeps_columns(frame):
    rows = chained(3, 6)
    docs = frame(rows)
    left = drop_near(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [i for i, _, _, kept in plain(rows, 5, 80) if kept]
