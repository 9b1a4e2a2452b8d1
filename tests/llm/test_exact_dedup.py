import hashlib
import re
from collections import Counter

from siteledger.llm.exact_dedup import drop_exact, exact_duplicates


def want(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    sizes, keep = Counter(norm), {}
    for (i, _), t in zip(rows, norm, strict=True):
        old = keep.get(t)
        keep[t] = i if old is None or i is not None and i < old else old
    return sorted((str(i), str(keep[t]), sizes[t], hashlib.sha256(t.encode()).hexdigest()) for (i, _), t in zip(rows, norm, strict=True))


def got(df):
    return sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in df.collect())


def test_classes_of_all_kinds_of_text(frame):
    long = "word after word " * 9000
    rows = [(1, "a  b"), (2, "a\t\nb"), (3, "a b "), (4, ""), (5, None), (6, "\v"), (7, long), (8, long + " "), (9, long[:-5]), (10, "x" + long)]
    rows += [(11, long[:8192]), (12, long[:8192]), (13, long[:16384] + "y"), (14, long[:16384] + "y"), (None, "a b"), (15, "only"), (3, "a b ")]
    df = exact_duplicates(frame(rows), block_bytes=4096)
    assert got(df) == want(rows)
    kept = df.where("kept").collect()
    assert len(kept) == len({r["text_sha256"] for r in kept}) == len({t for *_, t in want(rows)})


def test_whole_table_and_small_blocks(corpus, texts):
    assert got(exact_duplicates(corpus, block_bytes=16)) == want(sorted(texts.items()))


def test_hot_text(frame):
    rows = [(i, "the same text " * 50 if i % 3 else f"text {i}") for i in range(300)]
    assert got(exact_duplicates(frame(rows), block_bytes=64)) == want(rows)


def test_dropping_keeps_columns(frame):
    rows = [(3, "a b"), (1, "a  b"), (2, None), (4, ""), (1, "a  b"), (5, "z")]
    docs = frame(rows)
    left = drop_exact(docs)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in left.select("doc_id", "text").collect() if r["text"]) == [(1, "a  b"), (5, "z")]
    assert left.count() == 3


def test_empty_table(frame):
    assert exact_duplicates(frame([]).where("false")).count() == 0 and drop_exact(frame([])).count() == 0


def test_no_python_in_the_plans(corpus):
    plan = exact_duplicates(corpus)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
