"""Whole jobs: crawl, stream equals batch, clean-up, plan shapes."""

import pytest
from pyspark.sql import functions as F

from siteledger.operators import default_regions, extract_features, staged
from siteledger.plans import clean_up, crawl, read_pages
from siteledger.schemas import CONTACT_PAGES, PAGE_FETCH, PHONE_PREFIXES, PROBES, TABLES
from siteledger.streaming import REJECTS, SITE_TABLES, refresh_tables, site_table, stream_pages


def page(domain_id, seq, html, *, http=200, real=None, https=None, error=None):
    return (domain_id, f"d{domain_id}.ru", "ru", None, http, real or f"http://d{domain_id}.ru/", https, error, html, None, None, None, seq)


PAGES = [
    page(1, 1, '<title>One</title><p>ИНН 7707083893 </p><a href="mailto:a@d1.ru">m</a>', https="https://d1.ru/"),
    page(2, 2, '<title>404</title><img src="/bitrix/x">'),
    page(3, 3, "<title>Three</title><p>+7 (495) 123-45-67 </p>", real="https://www.d3.ru/"),
    page(4, 4, None, http=None, error="timeout"),
    page(5, 5, None, http=503),
    page(6, 6, '<title>Six</title><script src="/bitrix/x"></script>'),
    page(3, 7, None, http=None, error="connect"),
    page(7, 8, "<title>Copy of one</title>", real="http://d1.ru/"),
    page(1, 9, '<title>One again</title><p>ИНН 500100732259 </p><p> b@d1.ru </p>'),
    page(2, 10, None, http=None, error="ssl"),
]


@pytest.fixture(scope="module")
def inputs(spark):
    contact = [(3, "contacts", 200, False, "<p>x@d3.ru ИНН 500100732259 </p>"), (1, "about", 200, False, "<p>no@d1.ru</p>"),
               (7, "about", 200, False, "<p>no@d7.ru</p>")]
    probes = [(6, "cart", "cart", 404, False), (6, "catalog", "shop", 200, False)]
    return {
        "regions": default_regions(spark),
        "run_date": "2024-05-01",
        "contact_pages": spark.createDataFrame(contact, CONTACT_PAGES),
        "probes": spark.createDataFrame(probes, PROBES),
        "prefixes": spark.createDataFrame([("7495", "Москва")], PHONE_PREFIXES),
    }


@pytest.fixture(scope="module")
def batch(spark, inputs):
    return crawl(start_tables(spark), spark.createDataFrame(PAGES, PAGE_FETCH), **inputs)


def start_tables(spark):
    domains = [(i, f"d{i}.ru", "ru", None, 200 if i == 5 else None) for i in range(1, 9)]
    return {
        n: spark.createDataFrame(domains if n == "domains" else [], TABLES[n]) for n in SITE_TABLES
    }


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_crawl_tables(batch):
    assert rows(batch["domains"], "id", "status", "real_domain") == [
        (1, 200, "http://d1.ru/"), (2, 228, "http://d2.ru/"), (3, 200, "https://www.d3.ru/"), (4, 408, ""),
        (5, 200, None), (6, 200, "http://d6.ru/"), (7, 200, "http://d1.ru/"), (8, None, None),
    ]
    info = {r["domain_id"]: r for r in batch["domain_info"].collect()}
    assert sorted(info) == [1, 3, 6]
    assert info[1]["title"] == "One again" and info[1]["inn"] == "500100732259" and info[1]["city"] == "Московская область"
    assert info[3]["city"] == "Москва" and info[3]["inn"] == "500100732259" and info[3]["is_www"]
    assert info[3]["is_https_redirect"] and info[3]["is_ssl"]
    assert (info[6]["cms"], info[6]["is_ecommerce"], info[6]["has_catalog"]) == ("Bitrix", False, True)
    assert {r["status"] for r in info.values()} == {"Отсутствует"}
    assert sorted(r["id"] for r in info.values()) == [1, 2, 3]
    assert rows(batch["domain_emails"], "domain_id", "email") == [(1, "a@d1.ru"), (1, "b@d1.ru"), (3, "x@d3.ru"), (7, "no@d7.ru")]
    assert rows(batch["domain_phones"], "domain_id", "number") == [(3, "74951234567")]
    assert rows(batch["inns"], "inn", "domain_id") == [("500100732259", 1), ("7707083893", 1)]
    assert rows(batch["domain_inns"], "inn", "domain_id") == [("500100732259", 3), ("7707083893", 1)]
    assert batch["domain_info_rejects"].count() == 0


def test_stream_equals_batch(spark, batch, inputs, tmp_path):
    root, feed, checkpoint = (str(tmp_path / n) for n in ("root", "feed", "checkpoint"))
    site_table(spark, root, "domains", 8).replace(start_tables(spark)["domains"])
    for part in (PAGES[:4], PAGES[4:]):
        for p in part:
            spark.createDataFrame([p], PAGE_FETCH).coalesce(1).write.mode("append").parquet(feed)
        stream_pages(spark, feed, root, checkpoint, max_files=3)
        refresh_tables(spark, root, **inputs)
    for name in SITE_TABLES:
        got = site_table(spark, root, name).read()
        cols = [c for c in got.columns if c != "id" or name == "domains"]
        assert rows(got, *cols) == rows(batch[name], *cols), name
    last = refresh_tables(spark, root, **inputs)
    assert stream_pages(spark, feed, root, checkpoint) == last


def test_stream_in_one_refresh_equals_batch(spark, batch, inputs, tmp_path):
    root, feed, checkpoint = (str(tmp_path / n) for n in ("root", "feed", "checkpoint"))
    site_table(spark, root, "domains", 8).replace(start_tables(spark)["domains"])
    spark.createDataFrame(PAGES, PAGE_FETCH).repartition(5).write.parquet(feed)
    stream_pages(spark, feed, root, checkpoint, max_files=2)
    refresh_tables(spark, root, **inputs)
    for name in SITE_TABLES:
        got = site_table(spark, root, name).read()
        assert rows(got, *got.columns) == rows(batch[name], *got.columns), name


def partition_files(root):
    """Written files of every partition of every table, with their times."""
    return {(p.parts[-3], p.parts[-2], p.name): p.stat().st_mtime_ns for p in root.glob("parts/*/_part=*/*.parquet")}


def test_a_refresh_neither_reads_nor_writes_partitions_it_does_not_touch(spark, inputs, tmp_path):
    root, feed, checkpoint = (str(tmp_path / n) for n in ("root", "feed", "checkpoint"))
    many = spark.range(1000, 1400).selectExpr("id", "concat('d', id, '.ru') AS domain", "'ru' AS zone", "CAST(NULL AS string) AS real_domain", "CAST(NULL AS int) AS status")
    site_table(spark, root, "domains", 32).replace(start_tables(spark)["domains"].unionByName(many))
    spark.createDataFrame(PAGES, PAGE_FETCH).coalesce(1).write.mode("append").parquet(feed)
    stream_pages(spark, feed, root, checkpoint)
    refresh_tables(spark, root, parts=32, **inputs)
    before, known = partition_files(tmp_path / "root"), {n: site_table(spark, root, n).read().collect() for n in SITE_TABLES}
    # Site 1 moves to a new address; what lies in other partitions is made unreadable meanwhile.
    page = {f.name: v for f, v in zip(PAGE_FETCH, PAGES[0])} if isinstance(PAGES[0], tuple) else dict(PAGES[0])
    page |= {"seq": 10_000}
    spark.createDataFrame([tuple(page.get(f.name) for f in PAGE_FETCH)], PAGE_FETCH).coalesce(1).write.mode("append").parquet(feed)
    stream_pages(spark, feed, root, checkpoint)
    part = spark.sql(f"SELECT CAST(pmod(xxhash64(CAST({page['domain_id']} AS bigint)), 32) AS int) AS p").first()["p"]
    spoilt = [p for t in ("domains", "domain_phones", "domain_emails") for p in (tmp_path / "root" / "parts" / t).glob("_part=*/*.parquet") if p.parts[-2] != f"_part={part}"]
    whole = {p: p.read_bytes() for p in spoilt}
    assert len(spoilt) > 20
    for p in spoilt:
        p.write_bytes(b"unreadable")
        p.with_name(f".{p.name}.crc").unlink(missing_ok=True)
    refresh_tables(spark, root, parts=32, **inputs)
    assert all(p.read_bytes() == b"unreadable" for p in spoilt)
    for p, data in whole.items():
        p.write_bytes(data)
    after = partition_files(tmp_path / "root")
    changed = {(t, part) for t, part, _ in set(before) ^ set(after)}
    assert ("domains", f"_part={part}") in changed
    assert {p for t, p in changed if t in ("domains", "domain_phones", "domain_emails", "domain_inns")} <= {f"_part={part}"}
    for name, rows_before in known.items():
        now = site_table(spark, root, name).read().collect()
        assert len(now) >= len(rows_before) and len({r["id"] for r in now}) == len(now)


def test_new_ids_go_on_above_those_of_untouched_partitions(spark, inputs, tmp_path):
    root, feed, checkpoint = (str(tmp_path / n) for n in ("root", "feed", "checkpoint"))
    site_table(spark, root, "domains", 16).replace(start_tables(spark)["domains"])
    for some in (PAGES[:3], PAGES[3:]):
        spark.createDataFrame(some, PAGE_FETCH).coalesce(1).write.mode("append").parquet(feed)
        stream_pages(spark, feed, root, checkpoint)
        refresh_tables(spark, root, parts=16, **inputs)
    for name in SITE_TABLES:
        ids = [r["id"] for r in site_table(spark, root, name).read().collect()]
        assert len(ids) == len(set(ids)), name
    assert all(spark.read.parquet(f"{root}/records/{name}").count() >= 0 for name in REJECTS)


def test_clean_up(spark, batch):
    kept, deleted = clean_up(batch["domain_info"].withColumn("title", F.when(F.col("domain_id") == 6, "404").otherwise(F.col("title"))))
    assert rows(kept, "domain_id") == [(1,), (3,)]
    assert rows(deleted, "domain_id", "title") == [(6, "404")]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_extraction_is_narrow_and_stays_in_the_jvm(spark):
    pages = spark.createDataFrame(PAGES, PAGE_FETCH)
    for df in (read_pages(pages), extract_features(pages)):
        plan = plan_of(df)
        assert "Exchange" not in plan and "Python" not in plan


def test_staged_tables_prune_columns(spark):
    plan = plan_of(staged(spark.range(10).selectExpr("id", "id as wide")).select("id"))
    assert "ReadSchema: struct<id:bigint>" in plan


def test_staged_folders_can_be_cleared(spark, tmp_path, monkeypatch):
    from pathlib import Path

    from siteledger.operators import clear_staged, sizing

    monkeypatch.setattr(sizing, "_staged_paths", [])
    kept = staged(spark.range(5))
    (path,) = sizing._staged_paths
    kept.write.parquet(str(tmp_path / "result"))
    assert Path(path).exists()
    assert clear_staged(spark) == 1
    assert not Path(path).exists() and clear_staged(spark) == 0
    assert spark.read.parquet(str(tmp_path / "result")).count() == 5
