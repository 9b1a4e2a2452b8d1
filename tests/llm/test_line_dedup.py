from siteledger.llm.line_dedup import LEAST_BYTES, LEAST_LINES, chunks, drop_repeated_chunks, repeated_chunks


def plain(rows):
    """{(id, text): removed (start, count) pairs}: chunks whose bytes occur earlier in (id, hash of the text, line) order."""
    seen, out = set(), {}
    for key, text in rows:
        gone = []
        for at, lines, data in chunks(text):
            if lines >= LEAST_LINES and len(data) >= LEAST_BYTES:
                if data in seen:
                    gone.append((at, lines))
                seen.add(data)
        out[key] = (text.count("\n") + 1, gone)
    return out


def test_whole_table_against_plain_search(corpus, texts):
    rows = repeated_chunks(corpus).collect()
    want = plain(sorted(texts.items()))
    assert len(rows) == len(want)
    for r in rows:
        lines, gone = want[r["doc_id"]]
        assert (r["lines"], r["removed"], r["spans"]) == (lines, sum(n for _, n in gone), ",".join(f"{a}:{n}" for a, n in gone))


LINES = [f"line {k} with some words that fill it up to a certain length" for k in range(400)]


def test_shifted_passages_are_found(frame):
    passage = LINES[100:160]
    rows = [(1, "\n".join(LINES[:30] + passage)), (2, "\n".join(["new first line"] + passage + LINES[300:320])), (3, "\n".join(LINES[200:230]))]
    found = {r["doc_id"]: r["removed"] for r in repeated_chunks(frame(rows)).collect()}
    assert found[1] == found[3] == 0 and 45 <= found[2] <= 60


def test_hot_passage_nulls_long_texts_and_repeated_rows(frame):
    hot = "\n".join(LINES[:40])
    rows = [(i, hot + f"\nown line {i}") for i in range(90)] + [(500, None), (501, ""), (None, hot), (502, hot), (502, hot), (503, "\n".join(LINES) * 60)]
    docs = frame(rows)
    found = repeated_chunks(docs).collect()
    assert len(found) == len(rows) - 1  # a repeated row is one document
    whole = [r for r in found if r["doc_id"] is None]
    assert whole[0]["removed"] == 0  # a null id comes first
    assert all(r["removed"] > 30 for r in found if r["doc_id"] in (0, 50, 502))
    left = drop_repeated_chunks(docs)
    assert left.columns == docs.columns and left.count() == len(rows)
    texts = {r["doc_id"]: r["text"] for r in left.collect()}
    assert texts[500] is None and texts[501] == "" and texts[None] == hot and "own line 7" in texts[7] and len(texts[7]) < len(hot) / 3


def test_empty_table(frame):
    assert repeated_chunks(frame([])).count() == 0
