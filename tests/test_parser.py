"""Extraction against the HTML parser of the Python library, page by page."""

import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from siteledger.operators import extract_features


class Page(HTMLParser):
    """Text, first title and links as a tree-building parser would give them."""

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.skip = self.in_title = False
        self.titles, self.parts, self.links, self.open = [], [], [], None
        self.feed(html)
        self.close()
        self.end_link()

    def end_link(self):
        if self.open is not None:
            self.links.append((self.open[0], "".join(self.open[1])))
        self.open = None

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.skip = True
        if tag == "title":
            self.in_title = True
            self.titles.append("")
        if tag == "a":
            self.end_link()
            if dict(attrs).get("href") is not None:
                self.open = (dict(attrs)["href"], [])

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skip = False
        if tag == "title":
            self.in_title = False
        if tag == "a":
            self.end_link()

    def handle_data(self, data):
        if self.skip:
            return
        if self.in_title:
            self.titles[-1] += data
        self.parts.append(data)
        if self.open is not None:
            self.open[1].append(data)


def check(spark, pages):
    rows = extract_features(pages.withColumn("real_url", F.lit("http://a.ru"))).select("html", "title", "text", "links").collect()
    for row in rows:
        page = Page(row["html"])
        title = (page.titles or [""])[0]
        for char in "\n\"'\\":
            title = title.replace(char, "")
        assert row["title"] == title.strip()
        assert row["text"] == "".join(page.parts)
        assert [(a["href"], a["text"]) for a in row["links"]] == page.links
    return len(rows)


def test_page_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html")
    assert check(spark, pages) == 250


def test_mixed_markup(spark):
    rng = random.Random(9)
    pieces = [
        "<p>", "</p>", "<b class='x>y'>", "</b>", "<br/>", "<!-- <a href='/no'>no</a> -->", "<script>var a = '<p>';</script>",
        "<style>p > a {}</style>", "<a href=\"/x?a=1&amp;b=2\">", "</a>", "<A HREF='/y'>", "<a name=\"n\">", "text ", "Текст", " 1 < 2 ",
        "&eacute;&nbsp;&#1071;", "<img alt=\"a > b\" src=x>", "a@b.ru", "\n", "<div data-href=\"no\">", "</div>", "<a id=1 href=/z>",
    ]
    pages = ["<html><head><title>T &laquo;1&raquo;</title></head>" + "".join(rng.choices(pieces, k=25)) for _ in range(300)]
    assert check(spark, spark.createDataFrame([(p,) for p in pages], "html string")) == 300
