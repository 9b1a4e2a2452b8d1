"""Classifier, status fold and clean-up."""

import random

import pytest
from pyspark.sql import functions as F

from siteledger.operators import (
    Rule,
    clean_domain_info,
    classify_pages,
    default_rules,
    error_status,
    page_status,
    resolve_status,
    split_valid,
)

PAGE = "page_id int, real_url string, title string, description string, text string, cms string"


def classify(spark, rules=None, *, url="", title="", description="", text="", cms=""):
    df = spark.createDataFrame([(1, url, title, description, text, cms)], PAGE)
    return page_status(classify_pages(df, rules)).first()


def test_default_rule_counts():
    count = {}
    for rule in default_rules():
        key = (rule.status, rule.word)
        count[key] = count.get(key, 0) + 1
    words = {1000: 13, 1100: 48, 1200: 13, 1300: 7, 1400: 15, 1500: 3, 1600: 2, 1700: 1, 2000: 1, 2200: 13,
             2300: 2, 2500: 1, 2600: 1, 2700: 1, 3000: 5, 3100: 2, 3200: 4}
    assert {s: n for (s, w), n in count.items() if w} == words
    assert {s: n for (s, w), n in count.items() if not w} == {1300: 1, 1700: 2, 3100: 1, 4200: 1, 4300: 1}


@pytest.mark.parametrize(
    "page, status",
    [
        (dict(title="Купить домен тут"), 1100),
        (dict(title="404", url="http://porn.ru"), 4200),
        (dict(title="404"), 1000),
        (dict(title="4040"), None),
        (dict(title="Домен example.ru продаётся"), 1700),
        (dict(title="ставки", description="ставки на спорт"), 2300),
        (dict(text="ok 403 Forbidden ok"), 3000),
        (dict(text="regxru"), 3100),
        (dict(text="Сайт только что создан"), None),
        (dict(title="success!"), None),
        (dict(title="success!go"), 1100),
        (dict(title="1 х BET"), 1300),
        (dict(title="Welcome"), None),
        (dict(title="FASTPANEL2"), 1100),
    ],
)
def test_default_rules(spark, page, status):
    assert classify(spark, **page)["junk_status"] == status


def test_word_rule_in_cyrillic(spark):
    rules = [Rule("title", 0, 1700, "домен")]
    assert classify(spark, rules, title="Купить домен тут")["junk_status"] == 1700
    assert classify(spark, rules, title="поддомены")["junk_status"] is None


def test_banword_is_first_of_its_category(spark):
    row = classify(spark, title="error: not found")
    assert (row["junk_status"], row["banword"]) == (1000, r"\bnot found\b")


def test_equal_to_plain_search(spark):
    import re

    rules = default_rules()
    rng = random.Random(1)
    words = [r.pattern for r in rules if r.word] + ["alpha", "домен", "сайт", "купить", ".", "ё"]
    pages = [
        (i, "http://a.ru", " ".join(rng.choices(words, k=2)) if rng.random() < 0.4 else "alpha",
         " ".join(rng.choices(words, k=1)) if rng.random() < 0.4 else "", "x" + rng.choice(words), "")
        for i in range(300)
    ]

    def plain(page):
        parts = dict(zip(("url", "title", "description", "content"), page[1:5]))
        for part in ("url", "title", "description", "content"):
            for rule in (r for r in rules if r.part == part):
                pattern = rf"\b{rule.pattern.lower()}\b" if rule.word else rule.pattern
                if re.search(pattern, parts[part].lower()):
                    return rule.status, pattern
        return None, None

    got = classify_pages(spark.createDataFrame(pages, PAGE)).collect()
    for row in got:
        assert (row["junk_status"], row["banword"]) == plain(pages[row["page_id"]])
    assert len({row["junk_status"] for row in got}) > 8


def test_junk_bitrix(spark):
    assert classify(spark, title="404", cms="Bitrix")["page_status"] == 228
    assert classify(spark, title="fine", cms="Bitrix")["page_status"] == 200
    df = page_status(classify_pages(spark.createDataFrame(
        [(1, "", "404", "", "", ""), (2, "", "ok", None, None, "")], PAGE)))
    valid, junk = split_valid(df)
    assert [r["page_id"] for r in valid.collect()] == [2]
    assert [r["page_id"] for r in junk.collect()] == [1]


def test_clean_up_leaves_no_junk(spark):
    rows = [(1, "http://a.ru", "404", None), (2, "http://porn.ru", "ok", ""), (3, "http://b.ru", None, None)]
    info = spark.createDataFrame(rows, "id int, real_domain string, title string, description string")
    kept, deleted = clean_domain_info(info)
    assert [r["id"] for r in kept.collect()] == [3]
    assert sorted(r["id"] for r in deleted.collect()) == [1, 2]
    assert clean_domain_info(kept)[1].count() == 0


def test_error_status(spark):
    kinds = ["connect", "os", "reset", "payload", "response", "timeout", "disconnect", "unicode", "ssl", "db", None]
    df = spark.createDataFrame([(k,) for k in kinds], "k string").select(error_status(F.col("k")).alias("s"))
    assert [r["s"] for r in df.collect()] == [404, 404, 404, 400, 400, 408, 800, 888, None, None, None]


def fold(status, attempts):
    codes = {"connect": 404, "os": 404, "reset": 404, "payload": 400, "response": 400, "timeout": 408,
             "disconnect": 800, "unicode": 888}
    real = "old"
    for http, page, kind in attempts:
        if kind is None and http == 200:
            status, real = page, "new"
            continue
        code = codes.get(kind) if kind else (http or None)
        if code is not None and status != 200:
            status, real = code, ""
    return status, real


def test_resolve_status_equals_fold(spark):
    rng = random.Random(7)
    domains, attempts, expected = [], [], {}
    for d in range(1500):
        status = rng.choice([None, 0, 200, 404, 408, 1000])
        mine = []
        for s in range(rng.randrange(0, 6)):
            kind = rng.choice([None, None, None, "timeout", "connect", "ssl", "disconnect", "db"])
            http = None if kind else rng.choice([200, 200, 403, 500, None, 0])
            page = rng.choice([200, 1000, 228]) if http == 200 else None
            mine.append((http, page, kind))
            attempts.append((d, s, http, page, kind, "new" if http == 200 else None))
        domains.append((d, f"d{d}", status, "old"))
        expected[d] = fold(status, mine)
    df = resolve_status(
        spark.createDataFrame(domains, "id long, domain string, status int, real_domain string"),
        spark.createDataFrame(attempts, "domain_id long, seq long, http_status int, page_status int, error_kind string, real_url string").repartition(3),
    )
    rows = df.collect()
    assert len(rows) == len(domains)
    assert {r["id"]: (r["status"], r["real_domain"]) for r in rows} == expected
