import random
from collections import defaultdict

import pytest

from siteledger.llm.line_dedup import LEAST_BYTES, LEAST_LINES, drop_repeated_passages, repeated_passages
from siteledger.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def passages(rows):
    """{key: lines in a run of enough lines and bytes that stands at an earlier place}, by all pairs of places of equal lines."""
    docs, where, out = [(key, (text or "").split("\n")) for key, text in rows], defaultdict(list), {}
    for d, (key, lines) in enumerate(docs):
        gone = set()
        for i, line in enumerate(lines):
            for e, j in where[line]:
                n, there = 0, docs[e][1]
                while i + n < len(lines) and j + n < len(there) and lines[i + n] == there[j + n]:
                    n += 1
                if n >= LEAST_LINES and len("\n".join(lines[i : i + n]).encode()) >= LEAST_BYTES:
                    gone.update(range(i, i + n))
            where[line].append((d, i))
        out[key] = gone
    return out


def lines_of(spans):
    pairs = [tuple(map(int, s.split(":"))) for s in spans.split(",") if s]
    assert all(a + n < b for (a, n), (b, _) in zip(pairs, pairs[1:]))
    return {k for a, n in pairs for k in range(a, a + n)}


def test_query_removes_all_of_every_passage(spark, texts):
    want = passages(sorted(texts.items()))
    rows = QUERIES["op2_line_chunks"](spark, SF).collect()
    assert sum(map(len, want.values())) > 0 and len(rows) == len(want)
    for r in rows:
        assert lines_of(r["removed_lines"]) == want[r["doc_id"]] and r["n_removed"] == len(want[r["doc_id"]])


@pytest.mark.parametrize("size", [2, 3, 4, 5, 6])
def test_short_passages_are_removed_whole(frame, size):
    line = "passage {} line {} of a length that is enough".format
    rows = [(i, "\n".join([f"own first {i}", *[line(i % 20, k) for k in range(size)], f"own last {i}"])) for i in range(40)]
    found = {r["doc_id"]: r["spans"] for r in repeated_passages(frame(rows)).collect()}
    assert found == {i: f"1:{size}" if i >= 20 else "" for i in range(40)}
    left = {r["doc_id"]: r["text"] for r in drop_repeated_passages(frame(rows)).collect()}
    assert left[3] == rows[3][1] and left[33] == "own first 33\nown last 33"


# A digest of a few values, so that different bytes meet; without a name, so that tasks get it by value.
weak = lambda data: bytes([len(data) % 3] * 16)


@pytest.mark.parametrize("options", [{}, {"digest": weak}])
def test_short_lines_overlaps_and_collisions(frame, options):
    some, words = random.Random(5), ["", "a", "bb", "a line of some twenty", "another line that alone has more than forty bytes in it"]
    rows = [(i, "\n".join(some.choice(words) for _ in range(some.randrange(1, 40)))) for i in range(60)]
    rows += [(100, None), (101, "\n" * 200), (102, "same\n" * 60)]
    want = passages(rows)
    found = {r["doc_id"]: lines_of(r["spans"]) for r in repeated_passages(frame(rows), **options).collect()}
    assert found == want


def test_null_ids_and_repeated_rows(frame):
    text = "a first line with many words\na second line with many words"
    rows = {(r["doc_id"], r["removed"]) for r in repeated_passages(frame([(2, text), (2, text), (None, text), (3, text + "!")])).collect()}
    assert rows == {(None, 0), (2, 2), (3, 0)}
