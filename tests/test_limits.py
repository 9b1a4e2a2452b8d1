"""No cap, prefix or size switch: large lists, long references, jobs planned on request."""

import sys

from catalog.planted import planted
from catalog.sites import _crawl
import pytest
from pyspark.sql import functions as F

from siteledger import functions as fn
from siteledger.operators import assign_ids, category_votes, identify_category, staged
from siteledger.operators import sizing

SF = "/root/testdata/sf0.001"


def test_a_large_tag_table_is_joined_and_a_small_one_broadcast(spark, monkeypatch):
    from siteledger.operators import sizing

    tags = spark.createDataFrame([(i, f"word{i}, other{i % 7}") for i in range(60_000)], "id int, tag string")
    pages = spark.createDataFrame([(1, "word5 word5 other3 x"), (2, "nothing"), (3, None)], "page_id long, text string")
    votes = category_votes(pages, tags.where("id < 10"), F.col("text"))
    plan = votes._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan.split("BroadcastHashJoin")[-1].split("Exchange hash")[0]
    assert sorted((r[0], r[1], r[2]) for r in votes.collect() if r[1] is not None) == [(1, 3, 1), (1, 5, 2)]
    best = identify_category(pages, tags, F.col("text"))
    assert sorted(map(tuple, best.collect())) == [(1, 5), (2, 0), (3, 0)]
    # Beyond the size of a broadcast the words of the pages meet those of the tags in a shuffle.
    monkeypatch.setattr(sizing.fits_broadcast, "__defaults__", (1000, 1 << 20))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        votes = category_votes(pages, tags, F.col("text"))
        plan = votes._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "word59999" not in plan
        found = {r["tag_id"]: r["votes"] for r in votes.where("page_id = 1").collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == {i: (i == 5) * 2 + (i % 7 == 3) for i in range(60_000) if i == 5 or i % 7 == 3}


@pytest.mark.parametrize("few", [0, 32])
def test_phrases_patterns_and_overlaps_count_like_a_search(spark, monkeypatch, few):
    import re

    from siteledger.operators import tagging

    monkeypatch.setattr(tagging, "FEW_PHRASES", few)

    texts = ["a b a b a", "x-y z x-y", "aa bb  aa bb", "c++ c++ d", "", None, "x y-z", "ab cd-ef", "Ж б Ж б", "a-b a b", "one two three two three", "a_b c", "three\ttwo three"]
    tags = [(1, "a b, x-y"), (2, "a b a"), (3, "aa bb, aa, aa"), (4, "c\\+"), (5, "x y-z , cd-ef"), (6, "Ж б"), (7, "two three"), (8, "a.b"), (9, "a a"), (10, " d ")]
    pages = spark.createDataFrame(list(enumerate(texts)), "page_id int, text string")
    table = spark.createDataFrame(tags, "id int, tag string")

    def plain(text):
        return {i: n for i, listed in tags if (n := sum(len(re.findall(rf"\b{t.strip()}\b", text or "")) for t in listed.split(",")))}

    got = {}
    for r in category_votes(pages, table, F.col("text")).collect():
        got.setdefault(r["page_id"], {}).update({r["tag_id"]: r["votes"]} if r["tag_id"] is not None else {})
    assert got == {i: plain(t) for i, t in enumerate(texts)}


def test_rows_of_one_key_are_added_up(spark):
    pages = spark.createDataFrame([(1, "a b"), (1, "a")], "page_id long, text string")
    tags = spark.createDataFrame([(7, "a"), (8, "b")], "id int, tag string")
    assert sorted(map(tuple, category_votes(pages, tags, F.col("text"), unique=False).collect())) == [(1, 7, 2), (1, 8, 1)]
    assert identify_category(pages, tags, F.col("text"), unique=False).collect()[0]["tag_id"] == 7


def test_references_of_any_length(spark):
    cases = {
        "x&#0000000065;y": "xAy", "&#65 &#66": "A B", "&#650;&#65;": "ʊA", "&#x0000041;&#X42": "AB", "&#99999999;": "&#99999999;",
        "&amp;lt;": "&lt;", "&unknown; &": "&unknown; &", "&#" + "0" * 5000 + "65;": "A", "&#55296;": "&#55296;",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", fn.text(F.col("t")).alias("got"))
    assert {r["t"]: r["got"] for r in df.collect()} == cases


def test_building_one_table_of_a_crawl_stages_the_pages_only(spark, monkeypatch):
    calls = []

    def counting(df):
        calls.append(df)
        return staged(df)

    monkeypatch.setattr(sys.modules["siteledger.plans.crawl"], "staged", counting)
    tables = _crawl(spark, SF)
    assert len(calls) == 1  # the pages
    assert tables["domains"] is tables["domains"] and len(calls) == 1 and set(tables) >= {"domain_info", "inns_rejects"}


def test_ids_over_many_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "300")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = assign_ids(spark.range(5000).select(F.col("id").alias("k")), 10, ["k"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((r["id"], r["k"]) for r in rows) == [(11 + k, k) for k in range(5000)]


def test_staged_tables_lie_in_the_checkpoint_folder(spark):
    assert sizing.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_planted_pages_are_not_shuffled(spark):
    plan = planted(spark, SF, "page_fetch")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
