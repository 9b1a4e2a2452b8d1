import random

import numpy as np
import pytest

from siteledger.llm.decontaminate import contamination, drop_contaminated, tiles, words


def plain_tiles(doc, item, least):
    """Greedy string tiling by its definition: the longest common run of free tokens again and again."""
    least = max(1, min(least, len(item)))
    free, open_, total = [True] * len(doc), [True] * len(item), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(doc)):
            for j in range(len(item)):
                n = 0
                while i + n < len(doc) and j + n < len(item) and free[i + n] and open_[j + n] and doc[i + n] == item[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return total
        free[i : i + n], open_[j : j + n] = [False] * n, [False] * n
        total += n


def test_tiles_cover_what_plain_tiling_covers():
    rnd = random.Random(5)
    for _ in range(150):
        doc, item = (np.array([rnd.randint(0, 3) for _ in range(rnd.randint(1, 24))], np.uint64) for _ in range(2))
        least = rnd.randint(1, 5)
        found = tiles(doc, item, least)
        assert all((doc[i : i + n] == item[j : j + n]).all() and n >= min(least, len(item)) for i, j, n in found)
        assert len({k for i, _, n in found for k in range(i, i + n)}) == sum(n for *_, n in found) == len({k for _, j, n in found for k in range(j, j + n)})
        want = plain_tiles(doc.tolist(), item.tolist(), least)
        assert abs(sum(n for *_, n in found) - want) <= least  # ties may be broken otherwise


PASSAGE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
PARTS = PASSAGE.split()
CASES = [
    (1, "before " + PASSAGE + " after"),
    (2, "x " + " ".join(PARTS[10:]) + " between other words here " + " ".join(PARTS[:10]) + " y"),  # reordered
    (3, " ".join(PARTS[:9])),  # less than half
    (4, " ".join(w.upper() + "," for w in PARTS)),
    (5, " ".join(f"{w} odd" for w in PARTS)),  # no run of five
    (6, None), (7, ""), (None, PASSAGE), (8, "filler " * 40000 + PASSAGE), (9, "two words"), (9, PASSAGE), (9, PASSAGE),
]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, PASSAGE), (2, None), (3, ""), (4, "two words"), (None, "nothing"), (0, PASSAGE + " phi"), (7, "seven " * 6)], "item_id long, text string")


@pytest.mark.parametrize("block", [10, 1 << 24])
def test_covered_items(frame, items, block):
    docs = frame(CASES)
    found = contamination(docs, items, ["doc_id"], block_bytes=block).select("_doc.doc_id", "_item", "_items", "_share").collect()
    hit = sorted(((r["doc_id"], r["_item"], r["_items"]) for r in found if r["_items"]), key=str)
    # Item 0 has one more word, so item 1 is covered better.
    assert hit == sorted([(1, 1, 2), (2, 1, 2), (4, 1, 2), (None, 1, 2), (8, 1, 2), (9, 4, 1), (9, 1, 2), (9, 1, 2)], key=str)
    left = drop_contaminated(docs, items, block_bytes=block)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [3, 5, 6, 7]


def test_whole_table_against_plain_coverage(spark, corpus, texts):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = {r["doc_id"]: r["_items"] for r in contamination(corpus, bench, ["doc_id"]).select("_doc.doc_id", "_items").collect()}
    known = [words(r["text"]) for r in bench.collect()]
    for doc, text in texts.items():
        own = words(text)
        want = sum(sum(n for *_, n in tiles(own, item)) >= 0.8 * len(item) for item in known if len(item) and len(np.intersect1d(own, item)) >= 0.5 * len(np.unique(item)))
        assert got[doc] == want
    assert sum(map(bool, got.values())) > 0


def test_empty_tables(frame, items):
    assert contamination(frame([]), items, ["doc_id"]).count() == 0
    assert contamination(frame([(1, PASSAGE)]), items.where("false"), ["doc_id"]).collect()[0]["_items"] == 0
