"""Lookups, contact pages, shop flags, tags."""

import random
import re

from pyspark.sql import functions as F

from siteledger.operators import (
    category_tags,
    category_votes,
    deal_properties,
    default_regions,
    delete_where,
    fits_broadcast,
    identify_category,
    inn_regions,
    merge_contact_pages,
    phone_locations,
    region_names,
    shop_flags,
)
from siteledger.schemas import CONTACT_PAGES, PROBES


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_category_tags(spark):
    category = spark.createDataFrame([(1, "c1")], "id int, name string")
    sub = spark.createDataFrame([(1, "s1", 1), (2, "s2", 9), (3, "s3", 1)], "id int, name string, category_id int")
    tags = spark.createDataFrame([(1, "x, y", 1), (2, "z", 2)], "id int, tag string, subcategory_id int")
    assert rows(category_tags(category, sub, tags), "*") == [("c1", "s1", "x, y", 1), (None, "s2", "z", 2)]


def test_regions(spark):
    inns = spark.createDataFrame([(1, "9301234567"), (1, "7707083893"), (2, "0012345678"), (3, "ab")], "domain_id long, inn string")
    own = spark.createDataFrame([(93, " Краснодарский край"), (77, "Москва")], "id int, region string")
    assert rows(inn_regions(inns, own), "domain_id", "region") == [(1, "Краснодарский край"), (1, "Москва")]
    both = inns.groupBy("domain_id").agg(F.sort_array(F.collect_list("inn")).alias("i")).select(
        "domain_id", region_names(F.col("i"), default_regions(spark)).alias("r")
    )
    assert rows(both, "*") == [(1, ["Москва", "Краснодарский край"]), (2, []), (3, [])]
    assert default_regions(spark).count() == 99


def test_phone_locations_take_the_longest_prefix(spark):
    prefixes = spark.createDataFrame(
        [("7495", "Москва"), ("749512", "Химки"), ("7812", "СПб"), ("7", "Россия")], "prefix string, location string"
    )
    phones = spark.createDataFrame([(1, "74951234567"), (2, "84957654321"), (3, "78121112233"), (4, "79990000000")], "domain_id long, number string")
    want = [(1, "Химки"), (2, "Москва"), (3, "СПб"), (4, "Россия")]
    assert rows(phone_locations(phones, prefixes), "domain_id", "location") == want
    assert rows(phone_locations(phones, prefixes.where("prefix <> '7'")), "domain_id") == [(1,), (2,), (3,)]
    assert rows(phone_locations(phones, prefixes.limit(0)), "domain_id") == []


def test_contact_pages(spark):
    main = spark.createDataFrame(
        [(1, [], ["7"], []), (2, ["m@x.ru"], [], []), (3, [], [], []), (4, [], [], [])],
        "domain_id long, emails array<string>, phones array<string>, inns array<string>",
    )
    pages = [
        (1, "contacts", 200, False, "<p>a@b.ru 7707083893</p>"),
        (1, "about", 200, None, "<p>a@b.ru</p><p> c@d.ru</p>"),
        (1, "contact", 404, False, "<p>no@no.ru</p>"),
        (2, "contacts", 200, False, "<p>x@y.ru</p>"),
        (3, "contacts", 200, False, "<p>x@y.ru</p>"),
        (3, "about", None, True, None),
    ]
    got = merge_contact_pages(main, spark.createDataFrame(pages, CONTACT_PAGES))
    assert rows(got, "*") == [
        (1, "emails", "a@b.ru"), (1, "emails", "c@d.ru"), (1, "inns", "7707083893"), (1, "phones", "7"), (2, "emails", "m@x.ru"),
    ]


def test_shop_flags(spark):
    sites = spark.createDataFrame(
        [(1, "Bitrix", "t", "http://a"), (2, "Bitrix", "Авторизация", "http://a"), (3, "Bitrix", "t", "http://auth.a"),
         (4, "", "t", "http://a"), (5, "Bitrix", "t", "http://a"), (6, "Bitrix", "t", "http://a"), (7, "Bitrix", "t", "http://a")],
        "domain_id long, cms string, title string, real_url string",
    )
    probes = [(d, "cart", "cart", 200, False) for d in (1, 2, 3, 4)]
    probes += [(5, "cart", "cart", 404, False), (5, "catalog", "shop", 200, False)]
    probes += [(6, "cart", "cart", 200, False), (6, "cart", "basket", None, True), (6, "catalog", "shop", 200, False)]
    got = shop_flags(sites, spark.createDataFrame(probes, PROBES))
    assert rows(got, "domain_id", "is_ecommerce", "has_catalog") == [
        (1, True, True), (2, False, False), (3, False, False), (4, False, False), (5, False, True), (6, False, True), (7, False, False),
    ]


def test_deals_and_delete(spark):
    deals = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, v string")
    ids = spark.createDataFrame([(1,), (1,), (3,), (9,)], "id long")
    assert rows(deal_properties(ids, deals), "id") == [(1,), (3,)]
    assert rows(delete_where(deals, ids), "id") == [(2,)]


def test_broadcast_needs_a_checked_size(spark):
    assert fits_broadcast(spark.range(100))
    assert not fits_broadcast(spark.range(100), max_rows=99)
    assert not fits_broadcast(spark.range(100), max_bytes=50)


def test_tags_equal_plain_counting(spark):
    rng = random.Random(2)
    tags = [
        (0, "w;lrkgjr%#wet;"), (1, "лес, дом, дом, красный лес"), (2, "дом , river"), (3, "end., b-c, "), (5, "зверь"),
    ]
    words = ["лес", "дом", "Дом", "красный", "river", "end.", "b-c", "лесной", "w;lrkgjr%#wet;x", "ё", ",", "лес."]
    pages = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 12)))) for i in range(120)]
    df, tag_df = spark.createDataFrame(pages, "page_id int, t string"), spark.createDataFrame(tags, "id int, tag string")

    def plain(text):
        return {i: sum(len(re.findall(rf"\b{t.strip()}\b", text)) for t in tag.split(",")) for i, tag in tags}

    votes = {(r["page_id"], r["tag_id"]): r["votes"] for r in category_votes(df, tag_df, F.col("t")).collect()}
    best = {r["page_id"]: r["tag_id"] for r in identify_category(df, tag_df, F.col("t")).collect()}
    for page_id, text in pages:
        rating = plain(text)
        for tag_id, n in rating.items():
            assert votes.get((page_id, tag_id), 0) == n, (text, tag_id)
        assert best[page_id] == max(rating, key=rating.get)
