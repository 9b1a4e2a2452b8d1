import re
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import permutations
from math import factorial

import numpy as np
import pytest

from siteledger.llm.filter_audit import audit, failures, filter_interactions, shapley_weights


def plain(rows, labels):
    """rows of (doc_id, text, source), labels of (doc_id, quality, toxic): every order applied step by step."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    last = 1 << 63
    first = {}
    for d, t, _ in rows:
        d, t = last if d is None else d, t or ""
        first[t] = min(first.get(t, last), d)
    parts = defaultdict(list)
    for d, t, s in rows:
        text = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = ""
        fails += "A" * (len(words) < 50) + "B" * (100 * len(set(words)) < 65 * len(words))
        fails += "C" * (100 * len(re.findall("[A-Z]", text)) > 5 * len(text)) + "D" * bool(re.search("[#$%&*|]", text))
        fails += "E" * ((last if d is None else d) > first[text])
        parts[s or ""].append((fails, d in good, d in toxic))
    out = set()
    for part, docs in parts.items():
        shares, steps = Counter(), []
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for k, letter in enumerate(order):
                gone = [x for x in left if letter in x[0]]
                left = [x for x in left if letter not in x[0]]
                redundant = sum(letter in x[0] for x in docs) - len(gone)
                alone = sum(x[0] == letter for x in docs)
                shares[letter] += len(gone)
                steps.append((part, order, k + 1, len(left), len(gone), redundant, alone, sum(x[1] for x in gone), sum(x[2] for x in gone)))
        out |= {(*s, shares[s[1][s[2] - 1]]) for s in steps}
    return out


def run(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS mask", "2 AS n", "3 AS part", "4 AS _id", "5 AS v")
    found = audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "7 AS good"))
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_against_every_order_step_by_step(spark):
    rng = np.random.default_rng(3)
    texts = ["", None, " \t", "one two # three", "A B C", "word " * 60, " ".join(f"w{i}" for i in range(80)), " ".join(f"W{i}|" for i in range(50)), "\x0b".join(map(str, range(49))), "é" * 30 + "AB"]
    rows = [(None if i % 41 == 0 else i % 190, texts[rng.integers(len(texts))], [None, "", "a", "b"][rng.integers(4)]) for i in range(300)]
    labels = [(int(d), *[[None, 0, 1][rng.integers(3)] for _ in range(2)]) for d in rng.integers(0, 200, 250)] + [(None, 1, 1)]
    assert run(spark, rows, labels) == plain(rows, labels)


def test_hot_text_repeated_rows_and_ties(spark):
    rows = [(5, "same $", "a")] * 40 + [(5, "same $", "b"), (9, "same $", "a"), (None, "same $", "c"), (7, "x " * 50_000, "a")]
    assert run(spark, rows, [(5, 1, 0), (5, 0, 1)]) == plain(rows, [(5, 1, 0), (5, 0, 1)])


def test_empty_tables(spark):
    assert run(spark, [], []) == set()
    assert run(spark, [(1, "a", "s")], []) == plain([(1, "a", "s")], [])


def test_documents(spark, corpus, texts):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = [tuple(r) for r in corpus.select("doc_id", "text", "source").collect()]
    assert {tuple(r) for r in audit(corpus, labels).collect()} == plain(rows, [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])


@pytest.mark.parametrize("n", [2, 3, 4, 5, 6])
def test_weights_give_the_mean_over_all_orders(n):
    rng = np.random.default_rng(n)
    value = [0, *map(int, rng.integers(-50, 50, 2**n - 1))]
    for i, weights in enumerate(shapley_weights(n)):
        total = Fraction(0)
        for order in permutations(range(n)):
            before = sum(1 << j for j in order[: order.index(i)])
            total += value[before | 1 << i] - value[before]
        assert sum(w * v for w, v in zip(weights, value, strict=True)) == total
    assert sum(sum(w[-1] for w in shapley_weights(n)) for _ in "1") == factorial(n)


def test_other_chains_of_filters(spark):
    rows = [("p", m, m % 2 == 0, False, m + 1) for m in range(8)]
    found = filter_interactions(spark.createDataFrame(rows, "part string, mask int, good boolean, toxic boolean, n long"), ["x", "y", "z"])
    assert found.count() == 6 * 3 and found.where("kept + removed > 36").isEmpty()


def test_counts_are_narrow(spark, corpus):
    counted, letters = failures(corpus, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    assert letters == list("ABCDE")
    assert sum(r["n"] for r in counted.collect()) == corpus.count()
    assert not any(f.name == "_text" for f in counted.schema)
