import re
import time
from collections import defaultdict

from test_pii import PLAIN, base, check, passes

from siteledger.llm.pii import CANDIDATE, CONFIDENCE, KINDS, LOOKS, ROUNDS, SUPPORT, personal_data


def around(text, pattern):
    """(start, match, word before, word after) with words looked for between matches only."""
    found = list(re.finditer(pattern, text))
    for k, m in enumerate(found):
        before = text[found[k - 1].end() if k else 0 : m.start()].split()
        after = text[m.end() : found[k + 1].start() if k + 1 < len(found) else len(text)].split()
        yield m.start(), m.group(), before[-1].lower() if before else "", after[0].lower() if after else ""


def places_of(texts):
    """(document, start, end, value, patterns, kind or None) of base spans and of words that touch none."""
    for doc, text in texts.items():
        seeds = [(s, s + len(v), v, b, a, k) for k in KINDS for s, v, b, a in around(text, PLAIN[k]) if passes(k, v)]
        words = []
        for s, v, b, a in around(text, CANDIDATE):
            front = len(v) - len(v.lstrip("\"'([{<"))
            v = v[front:].strip("\"'([{<>}]).,;:!?")
            s += front
            if v and not any(x[0] < s + len(v) and s < x[1] for x in seeds):
                words.append((s, s + len(v), v, b, a, None))
        for s, e, v, b, a, k in seeds + words:
            yield doc, s, e, v, [p for p in (f"< {b}" if b else "", f"> {a}" if a else "", f"< {b}> {a}" if a and b else "") if p], k


def bootstrap(texts):
    """Spans of the plain loop: patterns scored by seeds and believed words, words by their best pattern."""
    places, believed = list(places_of(texts)), {}
    for _ in range(ROUNDS):
        all_, mine = defaultdict(int), defaultdict(float)
        for _, _, _, value, patterns, kind in places:
            for p in patterns:
                all_[p] += 1
                for k in KINDS:
                    mine[p, k] += (kind == k) if kind else believed.get((value, k), 0.0)
        best = defaultdict(float)
        for _, _, _, value, patterns, kind in places:
            for k in KINDS:
                if kind is None and re.search(LOOKS[k], value):
                    best[value, k] = max([best[value, k], *[mine[p, k] / (all_[p] + SUPPORT) for p in patterns]])
        believed = best
    spans = defaultdict(list)
    for doc, s, e, value, _, kind in places:
        if kind is None:
            top = max(believed.get((value, k), 0.0) for k in KINDS)
            if top >= CONFIDENCE:
                kind = next(k for k in KINDS if believed.get((value, k), 0.0) == top)
        if kind:
            spans[doc].append((s, KINDS.index(kind), e))
    return {doc: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans[doc])) for doc in texts}


def test_equals_a_plain_loop_and_finds_spaced_numbers(frame):
    texts = {i: f"Please call +1 (555) 010-{i:04d} {'today' if i % 2 else f'word{chr(97 + i % 26)}'} or mail user{i}@mail.example now." for i in range(120)}
    texts |= {200 + i: f"Room {i} holds 12 34 56 parts, made {1900 + i} times for x{i}@y." for i in range(40)}
    texts |= {300: "Please call 555 010 9999.", 301: "Please call (555) 010 9998, or mail boss@intranet now", 302: "They sold 555 010 9997 of 12 34.", 303: "call 5550109996 12 times"}
    found = {r["doc_id"]: r["spans"] for r in personal_data(frame(list(texts.items()))).collect()}
    assert found == bootstrap(texts)
    assert found[300] == "phone:12:24" and found[302] == ""


def test_forty_thousand_spans_in_one_text(frame):
    text = "a@b.c 12 " * 40_000
    docs = frame([(1, text), (2, "+1 555 123 4567 a@b.c")])
    begin = time.monotonic()
    rows = personal_data(docs).collect()
    assert time.monotonic() - begin < 120
    check(rows, {1: text, 2: "+1 555 123 4567 a@b.c"})
    assert len(base(text)) == 40_000
