import hashlib
import re

import pytest

from siteledger.llm.pii import KINDS, personal_data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {
        "email": True, "ip": all(int(p) <= 255 for p in match.split(".")) if kind == "ip" else None,
        "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15,
    }[kind]


def base(text):
    found = [(m.start(), k, m.end()) for k, kind in enumerate(KINDS) for m in re.finditer(PLAIN[kind], text) if passes(kind, m.group())]
    return [f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(found)]


def check(rows, texts):
    for r in rows:
        want = base(texts[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), (r["doc_id"], want, r["spans"])
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s.startswith(k) for s in want) for k in KINDS]
        assert set(want) <= set(filter(None, r["spans"].split(",")))


def test_whole_table(corpus, texts):
    check(personal_data(corpus).collect(), texts)


ODD = [
    None, "", "a@b.c", "a@b.c_d@e.f", "x a.b@c-d.e-f.g, y@z", "@a.b", "a@b", "é😀 a@b.de ü 1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "0255.0.0.1", "1.2.3", "12.34.56.78.9",
    "4111 1111 1111 1111", "4111-1111-1111-1112", "4111111111111111 4111111111111111", "41111111111111110000000", "+1 (736) 555-2678", "+1", "+1 2", "++12345678901", "+1234567890 -",
    "+1 555 123 4567+1 555 123 4567", "a" * 100_000, "1" * 100_000, "1 " * 50_000, "+" + "1 " * 20_000, "1." * 20_000, "a." * 20_000 + "@b.c", "a@" * 20_000, "a@b.c " * 3000,
]


def test_odd_texts(frame):
    texts = dict(enumerate(ODD))
    check(personal_data(frame(list(texts.items()))).collect(), texts)


@pytest.fixture(scope="module")
def contexts():
    """Phone numbers stand behind "reach me at", years and parts behind other words."""
    rows = [(i, f"Please reach me at +1 (555) 010-{i:04d} today or later.") for i in range(200)]
    rows += [(1000 + i, f"It was made in {1900 + i} as part number 55512{i:05d} of them.") for i in range(100)]
    return [*rows, (2000, "Please reach me at 555-010-9999 today or later."), (2001, "They sold 555-010-8888 of those."), (2002, "Please reach me at noon today.")]


def test_context_gives_unseen_identifiers_away(frame, contexts):
    rows = {r["doc_id"]: r for r in personal_data(frame(contexts)).collect()}
    assert rows[2000]["spans"] == "phone:19:31" and rows[2000]["n_phone"] == 0 and rows[2000]["n_added"] == 1
    assert all(r["n_added"] == 0 for i, r in rows.items() if i != 2000)
    assert rows[2001]["spans"] == rows[2002]["spans"] == ""


def test_null_ids_repeats_and_empty_tables(frame):
    rows = personal_data(frame([(None, "a@b.c"), (1, "a@b.c"), (1, "a@b.c")])).collect()
    assert [r["spans"] for r in rows] == ["email:0:5"] * 3
    assert personal_data(frame([])).count() == 0


def test_no_python_in_the_plan(corpus):
    plan = personal_data(corpus)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
