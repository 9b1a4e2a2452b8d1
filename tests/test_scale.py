"""Hot keys: one key with a third of all rows or more."""

import pytest
from pyspark.sql import functions as F

from siteledger.operators import (
    category_votes,
    contact_finds,
    dedupe_real_domain,
    last_per_key,
    phone_locations,
    real_domain_copies,
    resolve_status,
    shop_flags,
    upsert_domain_info,
    upsert_inns,
)
from siteledger.schemas import PHONE_PREFIXES

N = 30_000


@pytest.fixture(scope="module")
def rows(spark):
    """N rows; every third has the key 0."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    return spark.range(0, N, 1, 8).select(F.col("id").alias("seq"), key.alias("k"))


def shuffled_rows(df):
    """Rows that left the widest shuffle of an executed query."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    stack, most = [plan], 0
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name in ("Exchange", "ShuffleQueryStage"):
            metric = node.metrics().get("shuffleRecordsWritten")
            if metric.isDefined():
                most = max(most, metric.get().value())
        if name == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
        if name.endswith("QueryStage"):
            stack.append(node.plan())
        children = node.children()
        stack.extend(children.apply(i) for i in range(children.size()))
    return most


def test_hot_key_shrinks_before_the_shuffle(rows):
    unique = N - N // 3 + 1
    last = last_per_key(rows, ["k"], "seq")
    assert last.count() == unique
    assert last.where("k = 0").first()["seq"] == N - 3
    assert shuffled_rows(last) <= unique + 8


def test_hot_real_domain_upsert(spark, rows):
    name = F.concat(F.lit("r"), F.col("k").cast("string"))
    batch = rows.select((F.col("seq") + 100).alias("domain_id"), name.alias("real_domain"), F.col("seq").cast("string").alias("title"), "seq")
    existing = spark.createDataFrame([(1, 7, "r0", "old")], "id long, domain_id long, real_domain string, title string")
    table, rejects = upsert_domain_info(existing, batch, "seq")
    assert table.count() == N - N // 3 + 1
    assert [tuple(r) for r in table.where("real_domain = 'r0'").collect()] == [(1, 7, "r0", str(N - 3))]
    assert rejects.count() == 0
    # The owner moves away in the middle of the batch: the first row after it takes the name.
    moving = batch.unionByName(spark.createDataFrame([(7, "elsewhere", "moved", N // 2)], "domain_id long, real_domain string, title string, seq long"))
    table, _ = upsert_domain_info(existing, moving, "seq")
    found = {r["real_domain"]: r for r in table.where("real_domain IN ('r0', 'elsewhere')").collect()}
    assert found["elsewhere"]["domain_id"] == 7 and found["elsewhere"]["title"] == "moved"
    assert found["r0"]["domain_id"] == N // 2 + 3 + 100 and found["r0"]["title"] == str(N - 3)


def test_hot_domain_status(spark, rows):
    attempts = rows.select(
        F.col("k").alias("domain_id"), "seq", F.lit(200).alias("http_status"),
        F.when(F.col("seq") == N - 3, 1000).otherwise(200).alias("page_status"),
        F.lit(None).cast("string").alias("error_kind"), F.lit("u").alias("real_url"),
    )
    domains = spark.createDataFrame([(0, "a", "ru", "", 0), (1, "b", "ru", "", 0)], "id long, domain string, zone string, real_domain string, status int")
    assert sorted(tuple(r) for r in resolve_status(domains, attempts).select("id", "status").collect()) == [(0, 1000), (1, 200)]


def test_hot_inn(spark, rows):
    batch = rows.select(F.col("k").cast("string").alias("inn"), F.when(F.col("seq") % 2 == 0, F.col("seq") + 2).alias("domain_id"), "seq")
    existing = spark.createDataFrame([(1, "0", None)], "id long, inn string, domain_id long")
    table, rejects = upsert_inns(existing, batch, "seq")
    assert table.where("inn = '0'").first()["domain_id"] == max(i for i in range(0, N, 3) if i % 2 == 0) + 2
    assert rejects.count() == sum(1 for i in range(0, N, 3) if i % 2)


def test_hot_groups_in_lookups(spark, rows):
    copies = real_domain_copies(rows.select(F.col("k").cast("string").alias("real_domain")))
    assert [tuple(r) for r in copies.collect()] == [("0", N // 3)]
    kept = dedupe_real_domain(rows.select(F.col("seq").alias("id"), F.col("k").cast("string").alias("real_domain")))
    assert kept.count() == N - N // 3 + 1
    probes = rows.select(F.col("k").alias("domain_id"), F.lit("cart").alias("probe_group"), F.lit("x").alias("section"), F.lit(200).alias("status"), F.lit(False).alias("failed"))
    sites = spark.createDataFrame([(0, "Bitrix", "t", "u")], "domain_id long, cms string, title string, real_url string")
    assert shop_flags(sites, probes).first()["is_ecommerce"]
    pages = rows.select(
        F.col("k").alias("domain_id"), F.lit("about").alias("section"), F.lit(200).alias("status"), F.lit(False).alias("failed"),
        F.concat(F.lit("<p>m"), (F.col("seq") % 50).cast("string"), F.lit("@a.ru</p>")).alias("html"),
    )
    finds = contact_finds(pages)
    assert finds.where("domain_id = 0").count() == 50
    numbers = rows.select(F.col("k").alias("domain_id"), F.lit("74951234567").alias("number"))
    prefixes = spark.createDataFrame([("7495", "x")], PHONE_PREFIXES)
    assert phone_locations(numbers, prefixes).count() == N
    words = spark.createDataFrame([(1, "hot " * N)], "page_id int, t string")
    tags = spark.createDataFrame([(1, "hot")], "id int, tag string")
    assert category_votes(words, tags, F.col("t")).where("tag_id = 1").first()["votes"] == N


def test_large_side_is_not_broadcast(spark, monkeypatch):
    from siteledger.operators import sizing

    monkeypatch.setattr(sizing.fits_broadcast, "__defaults__", (5, 1000))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        phones = spark.range(100).select(F.col("id").alias("domain_id"), F.concat(F.lit("7"), F.lpad(F.col("id").cast("string"), 10, "0")).alias("number"))
        prefixes = spark.range(100).select(F.substring(F.concat(F.lit("7"), F.lpad(F.col("id").cast("string"), 10, "0")), 1, 10).alias("prefix"), F.lit("p").alias("location"))
        found = phone_locations(phones, prefixes)
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_ids_in_semi_and_anti_joins(spark, rows):
    from siteledger.operators import deal_properties, delete_where, fk_orphans

    ids = rows.select(F.col("k").alias("id"))
    table = spark.range(0, 2 * N)
    unique = N - N // 3 + 1
    hit = deal_properties(ids, table)
    assert hit.count() == unique
    assert delete_where(table, ids).count() == 2 * N - unique
    assert fk_orphans(rows, spark.range(0, 1), "k", "id").count() == N - N // 3
    assert fk_orphans(rows, spark.range(1, N), "k", "id").count() == N // 3


def test_hot_key_insert_and_upsert(spark, rows):
    from siteledger.operators import insert_ignore, upsert

    existing = spark.createDataFrame([(0, "old", "keep")], "k long, v string, w string")
    updates = rows.withColumn("v", F.col("seq").cast("string"))
    merged = upsert(existing, updates, ["k"], ["v"], "seq")
    assert merged.count() == N - N // 3 + 1
    assert tuple(merged.where("k = 0").first()) == (0, str(N - 3), "keep")
    added = insert_ignore(existing.limit(0), updates, ["k"], "seq")
    assert added.where("k = 0").first()["v"] == "0"
