"""Golden cases of the column functions."""

import random

import pytest
from pyspark.sql import functions as F

from siteledger import functions as fn


def one(spark, value, expr, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "inn, strict, kept",
    [
        ("7707083893", False, True),
        ("7707083894", False, False),
        ("500100732259", False, True),
        ("500100732250", False, False),
        ("7700000070", False, False),
        ("7700000070", True, True),
        ("12345", False, False),
        ("+770708389", False, False),
        (None, False, False),
    ],
)
def test_inn_checksum(spark, inn, strict, kept):
    assert one(spark, inn, lambda c: fn.is_valid_inn(c, strict)) is kept


def test_inns_of_text(spark):
    text = "ИНН 7707083893, 7707083893 и 500100732259; тел 77070838931 x7707083893"
    assert sorted(one(spark, text, fn.inns)) == ["500100732259", "7707083893"]


def page_contacts(spark, html, sep=""):
    row = (
        spark.createDataFrame([(html,)], "html string")
        .select(fn.strip_hidden(F.col("html")).alias("m"))
        .select(fn.text(F.col("m"), sep).alias("t"), fn.links(F.col("m")).alias("l"))
        .select("t", "l", fn.emails(F.col("t"), F.col("l")).alias("e"), fn.phones(F.col("t"), F.col("l")).alias("p"))
        .first()
    )
    return row


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<p>+7 (495) 123-45-67</p>", ["74951234567"]),
        ("<p>8 800 555-35-35</p>", ["88005553535"]),
        ("<p>+7 495 123</p>", []),
        ('<a href="tel:+7 (495) 123-45-67"></a>', ["74951234567"]),
        ('<a href="tel:123">8 (800) 555 35 35</a>', ["88005553535"]),
        ('<a href="tel:8-800-555-35-35">call</a>', []),
    ],
)
def test_phones(spark, html, expected):
    assert page_contacts(spark, html)["p"] == expected


@pytest.mark.parametrize(
    "html, sep, expected",
    [
        ('<a href="mailto:a@b.ru?subject=x"></a>', "", ["a@b.ru"]),
        ("<p>a@b.ru</p><p>next</p>", "", ["a@b.runext"]),
        ("<p>a@b.ru</p><p>next</p>", " ", ["a@b.ru"]),
        ("<p>Mail: A.b-c@d-e.com. Or</p>", "", ["A.b-c@d-e.com"]),
        ("<p>x&#64;y.com &#x41;&#1071;</p>", "", ["x@y.com"]),
        ("a@b.ru.x.y-z@q.com", "", ["a@b.ru.x.y", "-z@q.com"]),
        ("<script>a@b.ru</script><!-- c@d.ru -->", "", []),
        ("a@b.ru <script>c@d.ru", "", ["a@b.ru"]),
    ],
)
def test_emails(spark, html, sep, expected):
    assert page_contacts(spark, html, sep)["e"] == expected


def test_emails_equal_plain_scan(spark):
    import re

    from siteledger.functions.contacts import EMAIL

    rng = random.Random(5)
    texts = ["".join(rng.choice("ab1.-_@@. ,") for _ in range(60)) for _ in range(400)]
    rows = (
        spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        .select("i", fn.emails(F.col("t"), F.array().cast("array<struct<href string, text string>>")).alias("e"))
        .collect()
    )
    hits = 0
    for row in rows:
        plain = {m.strip("\"'.,") for m in re.findall(EMAIL, texts[row["i"]])}
        assert set(row["e"]) == plain
        hits += len(plain)
    assert hits > 50


def test_named_entities(spark):
    import html

    text = "&eacute;&Uuml;&nbsp;&laquo;x&raquo; &apos;&hellip;&sup2; &alpha; a&b; &amp;eacute; &amp;amp; & ; &euro;"
    assert one(spark, text, fn.decode_entities) == html.unescape(text)


def test_numeric_entities(spark):
    assert one(spark, "&#1071; &#x42F; &amp;lt; &lt;&copy; &#128512; &#0; &bogus;", fn.decode_entities) == "Я Я &lt; <© 😀 &#0; &bogus;"


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<title> A\"b' \n c&amp;d </title>", "Ab  c&d"),
        ("<html><TITLE lang='x'> Привет\\ </TITLE><title>two</title>", "Привет"),
        ("<body>none</body>", ""),
        ("<title>never closed<p>x</p>", ""),
        ("<!-- <title>no</title> --><title>yes</title>", "yes"),
    ],
)
def test_title(spark, html, expected):
    assert one(spark, html, lambda c: fn.title(fn.strip_hidden(c))) == expected


@pytest.mark.parametrize(
    "html, expected",
    [
        ('<meta name="description" content="a > b">', "a > b"),
        ("<meta content='first' name='description'><meta name=\"description\" content=\"second\">", "first"),
        ('<META NAME="description" CONTENT="x">', "x"),
        ('<meta name="Description" content="x">', ""),
        ('<meta name="description"><meta name="description" content="x">', ""),
        ('<meta property="og:description" content="x">', ""),
        ('<meta name=description content=plain>', "plain"),
        ('<meta name="description" content="it\'s">', "its"),
    ],
)
def test_description(spark, html, expected):
    assert one(spark, html, lambda c: fn.description(fn.meta_tags(c))) == expected


def test_keywords_are_cut(spark):
    html = f'<meta name="keywords" content=" {"k" * 1200}">'
    assert one(spark, html, lambda c: fn.keywords(fn.meta_tags(c), 1000)) == "k" * 1000
    assert one(spark, html, lambda c: fn.keywords(fn.meta_tags(c))) == "k" * 1200


def test_links(spark):
    html = """<a href="/x">X <b>y</b></a><a name=q>no</a><a href='/z'>open<a href=/w class="c>d">W</a>"""
    got = page_contacts(spark, html)["l"]
    assert [(a["href"], a["text"]) for a in got] == [("/x", "X y"), ("/z", "open"), ("/w", "W")]


def test_text_joins_without_separator(spark):
    html = '<title>T</title><style>p{}</style><p title="a>b">x</p><p>y &lt; z</p>1 < 2'
    assert one(spark, html, lambda c: fn.text(fn.strip_hidden(c))) == "Txy < z1 < 2"


def test_unfinished_tag_takes_the_rest(spark):
    html = "a<p " + "a" * 200_000 + "<a href=" + '"x' * 50_000
    assert one(spark, html, lambda c: fn.text(fn.strip_hidden(c))) == "a"


@pytest.mark.parametrize(
    "html, expected",
    [
        ('<link href="/wp-content/themes/x"><img src="/bitrix/y">', "Bitrix"),
        ('<link href="/wp-content/themes/x">', "Wordpress"),
        ('<meta name="generator" content="Joomla 3">', "Joomla"),
        ('<META NAME="generator" CONTENT="joomla">', ""),
    ],
)
def test_cms(spark, html, expected):
    assert one(spark, html, fn.cms) == expected


@pytest.mark.parametrize(
    "url, host", [("http://a.ru:80/x", "a.ru"), ("https://a.ru/", "a.ru"), ("http://a.ru/x", "a.ru/x")]
)
def test_bare_host(spark, url, host):
    assert one(spark, url, fn.bare_host) == host


@pytest.mark.parametrize("domain, zone", [("a.ru", "ru"), ("a.co.uk", "co.uk"), ("localhost", "")])
def test_zone(spark, domain, zone):
    assert one(spark, domain, fn.zone_of) == zone


def test_python_round2(spark):
    rng = random.Random(3)
    values = [0.0, 0.015, 0.125, 0.375, 0.005, 0.025, 0.995, 1.005, 2.675, 1e-9, 0.0039, 1234567.885, -0.015, -2.675, 5e12 + 0.125]
    values += [rng.randrange(1, 400) / 200 for _ in range(200)]
    values += [rng.randrange(0, 10**12) / 1000000 for _ in range(500)]
    values += [(rng.randrange(0, 10**7) * 10000 + 5000) / 1000000 for _ in range(300)]
    values += [rng.random() * 3 for _ in range(300)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", fn.python_round2(F.col("v")).alias("r")).collect()
    for row in rows:
        assert row["r"] == round(row["v"], 2), row


@pytest.mark.parametrize(
    "html",
    [
        "<script>" * 40_000 + "x" * 200_000,
        "<!-- " * 60_000,
        "<title>a" + " " * 300_000 + "b</title>",
        "<a href=x>" * 30_000,
        "<p '" * 50_000,
        "a." * 200_000 + "@",
        "&amp" * 100_000,
        "<meta name=" * 30_000,
        "<meta " * 30_000 + '"' + "x" * 100_000,
        "<title " * 30_000,
        "<title>" * 30_000,
        "<script " * 30_000,
        "<a href='" * 30_001,
    ],
)
def test_hostile_pages_take_linear_time(spark, html):
    import time

    from siteledger.operators import extract_features

    started = time.time()
    df = spark.createDataFrame([(html, "http://a.ru")], "html string, real_url string")
    assert extract_features(df).select(*[F.hash(c) for c in ("title", "description", "text", "links", "emails", "phones", "inns")]).count() == 1
    extract_features(df).collect()
    assert time.time() - started < 30


def test_company_names(spark):
    assert one(spark, "ООО Ромашка и ЗАО  Лес, ИП Иванов", fn.company_names) == ["ООО Ромашка", "ЗАО  Лес"]


def test_strip(spark):
    assert one(spark, "\n\t  a b  ", fn.python_strip) == "a b"
