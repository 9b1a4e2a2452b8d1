"""Readers, writers, quality checks, reports, CRM export."""

import json

import pytest
from pyspark.sql import functions as F

from siteledger import sources
from siteledger.operators import (
    upsert,
    audit_deleted,
    audit_invalid_cms,
    cms_counts,
    contact_updates,
    crm_params,
    crm_rename,
    deal_fields,
    deal_updates,
    first_n,
    fk_orphans,
    id_bounds,
    length_violations,
    null_violations,
    portion,
    real_domain_copies,
    retry_set,
    search_domains,
    status_counts,
    unique_violations,
    with_run_counters,
)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_domains_csv(spark, tmp_path):
    (tmp_path / "d.csv").write_text("domain,x\na.ru,1\nb.co.uk,2\na.ru,3\n")
    assert rows(sources.read_domains_csv(spark, str(tmp_path / "d.csv")), "*") == [("a.ru", "ru"), ("b.co.uk", "co.uk")]


def test_domains_txt_ids_follow_the_file(spark, tmp_path):
    lines = [f"d{i}.ru;REGISTRAR-{'RU' if i % 2 else 'SU'};x" for i in range(3000)]
    (tmp_path / "d.txt").write_text("\n".join(lines) + "\nnoregistrar")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 9000)
    try:
        df = sources.read_domains_txt(spark, str(tmp_path / "d.txt"))
        assert spark.read.text(str(tmp_path / "d.txt")).rdd.getNumPartitions() > 3
        got = sorted(tuple(r) for r in df.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got[:2] == [(0, "d0.ru", "SU"), (1, "d1.ru", "RU")]
    assert [(g[0], g[1]) for g in got] == [(i, f"d{i}.ru") for i in range(3000)] + [(3000, "noregistrar")]
    assert got[-1][2] is None


def test_inns_csv_takes_the_first_rows(spark, tmp_path):
    (tmp_path / "i.csv").write_text("inn\n" + "\n".join(f"{i % 1500:010d}" for i in range(4000)) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 9000)
    try:
        got = rows(sources.read_inns_csv(spark, str(tmp_path / "i.csv"), 1001), "inn")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [(f"{i:010d}",) for i in range(1001)]
    assert sources.read_inns_csv(spark, str(tmp_path / "i.csv"), None).count() == 1500


def test_json_rows(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"inn": "01", "domain_id": 1}, {"inn": "02", "domain_id": None}]))
    (tmp_path / "b.json").write_text(json.dumps({"inn": "03", "domain_id": 3}))
    df = sources.read_json_rows(spark, str(tmp_path))
    assert rows(df, "*") == [("01", 1), ("02", None), ("03", 3)]
    sources.write_inns_json(df, str(tmp_path / "out"))
    assert rows(spark.read.json(str(tmp_path / "out")), "inn", "domain_id") == [("01", 1), ("03", 3)]


def test_table_snapshots(spark, tmp_path):
    root = str(tmp_path)
    assert sources.read_table(spark, root, "regions").count() == 0
    sources.write_table(spark.createDataFrame([(1, "a")], "id int, region string"), root, "regions")
    old = sources.read_table(spark, root, "regions")
    seeded = sources.seed_lookup(old, spark.createDataFrame([(1, "x"), (2, "b")], "id int, region string"))
    assert sources.write_table(seeded, root, "regions") == 1
    assert rows(sources.read_table(spark, root, "regions"), "*") == [(1, "a"), (2, "b")]
    assert rows(old, "*") == [(1, "a")]


def test_filters(spark):
    df = spark.createDataFrame([(i, f"d{i}.ru", "r", 404 if i % 2 else 200) for i in range(1, 9)], "id long, domain string, real_domain string, status int")
    assert rows(portion(df, 3, 2), "id") == [(3,), (4,)]
    assert rows(portion(df, 3, 2, inclusive=False), "id") == [(4,), (5,)]
    assert rows(retry_set(df, 404, 3), "id") == [(3,), (5,), (7,)]
    assert rows(retry_set(df, 404, 3, 1), "id") == [(3,)]
    assert rows(id_bounds(df), "*") == [(1, 8, 8)]
    assert rows(first_n(df, 2), "id") == [(1,), (2,)]
    info = spark.createDataFrame([(1, 11), (2, None), (3, 13)], "domain_id long, bitrix_id long")
    assert rows(search_domains(df, info, "%.ru"), "*") == [("d1.ru", "r", 11), ("d3.ru", "r", 13)]


def test_reports(spark):
    info = spark.createDataFrame([(None, "a"), (None, "a"), ("Bitrix", "b"), ("", None), ("", None)], "cms string, real_domain string")
    assert [tuple(r) for r in cms_counts(info).collect()] == [("", 2), ("Bitrix", 1), (None, 0)]
    assert [tuple(r) for r in real_domain_copies(info).collect()] == [("a", 2)]
    assert rows(status_counts(spark.createDataFrame([(200,), (200,), (None,)], "status int")), "*") == [(200, 2), (None, 1)]


def test_quality(spark):
    df = spark.createDataFrame([(1, "aaaa", 5), (2, "aaaa", 6), (3, None, None), (4, None, 5)], "id long, s string, fk long")
    assert rows(unique_violations(df, ["s"]), "*") == [("aaaa", 2)]
    assert rows(fk_orphans(df, spark.createDataFrame([(5,)], "id long"), "fk", "id"), "id") == [(2,)]
    assert rows(length_violations(df, {"s": 3}), "*") == [(1, "s", 4, 3), (2, "s", 4, 3)]
    assert rows(null_violations(df, ["s", "fk"]), "*") == [(3, "fk"), (3, "s"), (4, "s")]


def test_crm(spark):
    deals = spark.createDataFrame([(501070, "http://станки.su/"), (2, "https://a.ru/x")], "bitrix_id long, real_domain string")
    params = rows(crm_params(deal_updates(deals)), "*")
    assert params == [(2, ".json?id=2&fields[TITLE]=a.ru/x&"), (501070, ".json?id=501070&fields[TITLE]=станки.su&")]
    contacts = spark.createDataFrame([(2, 7), (2, 8), (9, 9)], "bitrix_id long, contact_id long")
    assert rows(crm_params(contact_updates(deals, contacts), url_encode=True), "*") == [
        (7, ".json?id=7&fields[LAST_NAME]=a.ru%2Fx&"), (8, ".json?id=8&fields[LAST_NAME]=a.ru%2Fx&"),
    ]
    df = spark.createDataFrame([(1, "t", "77")], "id long, title string, inn string")
    assert crm_rename(df).columns == ["ID", "TITLE", "UF_CRM_1655722387"]
    assert rows(crm_params(deal_fields(df, ["title", "inn"])), "params") == [(".json?id=1&fields[TITLE]=t&fields[UF_CRM_1655722387]=77&",)]
    with pytest.raises(KeyError):
        crm_rename(df.withColumn("nope", F.lit(1)))


def test_audit(spark):
    df = spark.createDataFrame([(1, 2, "r", "t" * 150, None, 228, "w")], "id long, domain_id long, real_domain string, title string, description string, page_status int, banword string")
    assert rows(audit_deleted(df), "*") == [(1, 2, "r", "t" * 150, None)]
    assert rows(audit_deleted(df, 100), "*") == [(1, 2, "r", "t" * 100, None)]
    assert rows(audit_invalid_cms(df.withColumnRenamed("real_domain", "real_url")), "*") == [("r", 228, "w")]
    counted, seen = with_run_counters(df, "run", junk=F.count_if(F.col("page_status") != 200))
    counted.collect()
    assert seen.get == {"rows": 1, "junk": 1}


def test_upsert_touches_only_its_partitions(spark, tmp_path):
    rows_ = spark.range(0, 400).select("id", F.lit("old").alias("v"), F.lit("keep").alias("w"))
    table = sources.PartitionedTable(spark, str(tmp_path), "t", rows_.schema, ("id",), 16)
    assert table.read().count() == 0 and table.near(rows_).count() == 0
    table.replace(rows_)
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "parts" / "t").glob("_part=*/*.parquet")}
    assert len({p.parent for p in files}) == 16
    updates = spark.createDataFrame([(5, "new", 1), (5, "newer", 2), (9000, "added", 1)], "id long, v string, seq long")
    expected = {r["id"]: (r["v"], r["w"]) for r in rows_.collect()} | {5: ("newer", "keep"), 9000: ("added", None)}
    # The number of partitions is that of the first write.
    again = sources.PartitionedTable(spark, str(tmp_path), "t", rows_.schema, ("id",), 4)
    for _ in range(2):
        again.replace(upsert(again.near(updates), updates, ["id"], ["v"], "seq"))
        read = again.read()
        assert {r["id"]: (r["v"], r["w"]) for r in read.collect()} == expected and read.count() == len(expected)
        now = {p: p.stat().st_mtime_ns for p in (tmp_path / "parts" / "t").glob("_part=*/*.parquet")}
        assert 1 <= len({p.parent for p in set(files) - set(now)}) <= 2
        assert all(now[p] == files[p] for p in set(files) & set(now))
