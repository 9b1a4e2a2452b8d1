"""Sources, filters, reports and quality checks (S, F, A, Q)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from siteledger import sources
from siteledger.functions import host_of
from siteledger.operators import (
    audit_deleted,
    audit_invalid_cms,
    cms_counts,
    clean_domain_info,
    column_counts,
    count_status,
    first_n,
    fk_orphans,
    id_bounds,
    length_violations,
    null_violations,
    portion,
    real_domain_copies,
    real_domain_counts,
    retry_set,
    search_domains,
    shared_dir,
    status_counts,
    unique_violations,
    with_domain,
)
from siteledger.plans import load_domain_inns, load_domains, load_inns, read_pages

from . import register, table
from .planted import planted, planted_sql

SQL_HOST = "lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)', 1))"


def _scratch(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@register("s1_domain_csv", f"""SELECT DISTINCT {SQL_HOST} AS domain,
    regexp_replace({SQL_HOST}, '^[^.]*\\.?', '') AS zone FROM pages""")
def _(spark, sf):
    path = _scratch(spark, "domains-csv")
    table(spark, sf, "pages").select(host_of(F.col("url")).alias("domain")).write.option("header", True).csv(path)
    return sources.read_domains_csv(spark, path)


@register("s2_domain_txt", """SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS id, 'd' || c_custkey || '.ru' AS domain,
    CASE WHEN c_custkey % 2 = 0 THEN 'RU' ELSE 'SU' END AS zone FROM customer""")
def _(spark, sf):
    path = _scratch(spark, "domains-txt")
    line = F.concat(F.lit("d"), "c_custkey", F.lit(".ru;REG-"), F.when(F.col("c_custkey") % 2 == 0, "RU").otherwise("SU"), F.lit(";x"))
    table(spark, sf, "customer").orderBy("c_custkey").select(line.alias("value")).write.text(path)
    return sources.read_domains_txt(spark, path)


@register("s3_inn_csv", "SELECT DISTINCT lpad(CAST(o_custkey AS STRING), 10, '0') AS inn FROM orders")
def _(spark, sf):
    path = _scratch(spark, "inns-csv")
    inn = F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("inn")
    table(spark, sf, "orders").orderBy("o_orderkey").select(inn).write.option("header", True).csv(path)
    return sources.read_inns_csv(spark, path)


@register("s4_json_rows", planted_sql("inn_rows") + "SELECT inn, domain_id FROM inn_rows")
def _(spark, sf):
    path = _scratch(spark, "inn-arrays")
    sources.write_json_arrays(planted(spark, sf, "inn_rows").repartition(8, "inn"), path)
    return sources.read_json_rows(spark, path)


@register("s5_inns_with_domain", planted_sql("inn_rows") + "SELECT inn, domain_id FROM inn_rows WHERE domain_id IS NOT NULL")
def _(spark, sf):
    path = _scratch(spark, "inns-json")
    sources.write_inns_json(planted(spark, sf, "inn_rows"), path)
    return spark.read.schema("inn string, domain_id bigint").json(path)


@register("f5_with_domain", planted_sql("inn_rows") + "SELECT inn, domain_id FROM inn_rows WHERE domain_id IS NOT NULL")
def _(spark, sf):
    return with_domain(planted(spark, sf, "inn_rows"))


@register("s6_table_round_trip", planted_sql("domains") + "SELECT id, domain, zone, real_domain, status FROM domains")
def _(spark, sf):
    root = _scratch(spark, "tables")
    sources.write_table(planted(spark, sf, "domains").limit(0), root, "domains")
    sources.write_table(planted(spark, sf, "domains"), root, "domains")
    return sources.read_table(spark, root, "domains")


@register("s7_seed_lookup", """SELECT s_suppkey AS id, s_name AS name FROM supplier UNION ALL
    SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)""")
def _(spark, sf):
    there = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    seed = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return sources.seed_lookup(there, seed)


SQL_SITE_HIT = ("(contains(lower(real_domain), 'porn') OR coalesce(title, '') IN ('404 Not Found', 'Купить домен тут') "
                "OR description = 'Ставки на спорт')")


@register("s8_audit_deleted", planted_sql("site_info") + f"""SELECT id, domain_id, real_domain, title, description
    FROM site_info WHERE {SQL_SITE_HIT}""")
def _(spark, sf):
    return audit_deleted(clean_domain_info(planted(spark, sf, "site_info"))[1])


SQL_IS_PAGE = "http_status = 200 AND error_kind IS NULL"


@register("s8_audit_invalid_cms", planted_sql("page_fetch") + f"""SELECT real_url, 228 AS page_status, CASE
    WHEN contains(real_url, 'porn') THEN 'porn' WHEN domain_id % 11 = 3 THEN '\\b404\\b' WHEN domain_id % 13 = 5 THEN '\\bкупить домен\\b'
    ELSE '\\baccount has been suspended\\b' END AS banword FROM page_fetch WHERE {SQL_IS_PAGE} AND domain_id % 7 = 3 AND
    (contains(real_url, 'porn') OR domain_id % 11 = 3 OR domain_id % 13 = 5 OR (domain_id % 19 = 4 AND domain_id % 2 = 0))""")
def _(spark, sf):
    return audit_invalid_cms(read_pages(planted(spark, sf, "page_fetch")))


@register("f1_portion", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey >= 500 ORDER BY o_orderkey LIMIT 1000")
def _(spark, sf):
    return portion(table(spark, sf, "orders"), 500, 1000, key="o_orderkey").select("o_orderkey", "o_custkey")


@register("f2_retry_set", planted_sql("order_domains") + "SELECT id, domain, status FROM order_domains WHERE status = 404 AND id >= 0")
def _(spark, sf):
    return retry_set(planted(spark, sf, "order_domains"), 404).select("id", "domain", "status")


@register("f2_retry_timeouts", planted_sql("order_domains") + "SELECT id, domain, status FROM order_domains WHERE status = 408 AND id >= 1000")
def _(spark, sf):
    return retry_set(planted(spark, sf, "order_domains"), 408, 1000).select("id", "domain", "status")


@register("f3_id_bounds", "SELECT min(o_orderkey) AS first_id, max(o_orderkey) AS last_id, count(*) AS n FROM orders")
def _(spark, sf):
    return id_bounds(table(spark, sf, "orders"), "o_orderkey")


SQL_PAGE_DOMAINS = f"""WITH domains AS (SELECT page_id AS id, {SQL_HOST} AS domain, url AS real_domain FROM pages),
    info AS (SELECT page_id AS domain_id, CASE WHEN page_id % 3 > 0 THEN page_id * 10 END AS bitrix_id FROM pages) """


def _page_domains(spark, sf):
    pages = table(spark, sf, "pages")
    domains = pages.select(F.col("page_id").alias("id"), host_of(F.col("url")).alias("domain"), F.col("url").alias("real_domain"))
    info = pages.select(F.col("page_id").alias("domain_id"), F.when(F.col("page_id") % 3 > 0, F.col("page_id") * 10).alias("bitrix_id"))
    return domains, info


@register("f4_search_domains", SQL_PAGE_DOMAINS + """SELECT domain, real_domain, bitrix_id FROM info JOIN domains ON id = domain_id
    WHERE domain LIKE '%.example.com' AND bitrix_id IS NOT NULL""")
def _(spark, sf):
    return search_domains(*_page_domains(spark, sf), "%.example.com")


@register("f6_first_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 150")
def _(spark, sf):
    return first_n(table(spark, sf, "orders"), 150, "o_orderkey").select("o_orderkey", "o_totalprice")


@register("a1_cms_counts", planted_sql("order_domains") + "SELECT cms, count(cms) AS count FROM order_domains GROUP BY cms")
def _(spark, sf):
    return cms_counts(planted(spark, sf, "order_domains"))


@register("a2_status_counts", planted_sql("order_domains") + "SELECT status, count(*) AS count FROM order_domains GROUP BY status")
def _(spark, sf):
    return status_counts(planted(spark, sf, "order_domains"))


@register("a3_timeout_count", planted_sql("order_domains") + "SELECT count(*) AS count FROM order_domains WHERE status = 408")
def _(spark, sf):
    return count_status(planted(spark, sf, "order_domains"), 408)


@register("a4_junk_bitrix_count", planted_sql("order_domains") + "SELECT count(*) AS count FROM order_domains WHERE status = 228")
def _(spark, sf):
    return count_status(planted(spark, sf, "order_domains"), 228)


@register("a5_real_domain_counts", f"SELECT {SQL_HOST} AS real_domain, count({SQL_HOST}) AS domain_count FROM pages GROUP BY 1")
def _(spark, sf):
    return real_domain_counts(table(spark, sf, "pages").select(host_of(F.col("url")).alias("real_domain")))


@register("a6_real_domain_copies", planted_sql("order_domains") + """SELECT real_domain, count(real_domain) AS domain_count
    FROM order_domains GROUP BY real_domain HAVING count(real_domain) > 1""")
def _(spark, sf):
    return real_domain_copies(planted(spark, sf, "order_domains"))


@register("a7_counts", planted_sql("order_domains") + "SELECT count(*) AS n_rows, count(real_domain) AS n_values FROM order_domains")
def _(spark, sf):
    return column_counts(planted(spark, sf, "order_domains"), "real_domain")


@register("a9_distinct_hosts", f"SELECT DISTINCT {SQL_HOST} AS host FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select(host_of(F.col("url")).alias("host")).distinct()


@register("q1_unique_violations", """SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 1""")
def _(spark, sf):
    return unique_violations(table(spark, sf, "orders"), ["o_custkey", "o_orderstatus"])


@register("q2_fk_orphans", """SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)""")
def _(spark, sf):
    return fk_orphans(table(spark, sf, "customer"), table(spark, sf, "supplier"), "c_custkey", "s_suppkey").select("c_custkey", "c_name")


@register("q3_length_violations", """SELECT doc_id, 'text' AS column_name, CAST(length(text) AS INT) AS length, 255 AS max_length
    FROM documents WHERE length(text) > 255 UNION ALL SELECT doc_id, 'source', CAST(length(source) AS INT), 4 FROM documents WHERE length(source) > 4""")
def _(spark, sf):
    return length_violations(table(spark, sf, "documents"), {"text": 255, "source": 4}, "doc_id")


@register("q4_null_violations", planted_sql("order_domains") + """SELECT id, 'real_domain' AS column_name FROM order_domains WHERE real_domain IS NULL
    UNION ALL SELECT id, 'cms' FROM order_domains WHERE cms IS NULL""")
def _(spark, sf):
    return null_violations(planted(spark, sf, "order_domains"), ["real_domain", "cms"])


@register("plan_load_domains", planted_sql("domains") + """, n AS (SELECT DISTINCT 'n' || (o_custkey % 500) || '.ru' AS domain FROM orders),
    m AS (SELECT max(id) AS last FROM domains) SELECT id, domain, zone, real_domain, status FROM domains UNION ALL
    SELECT last + row_number() OVER (ORDER BY domain), domain, 'ru', NULL, NULL FROM n, m""")
def _(spark, sf):
    path, known = _scratch(spark, "domains-csv"), planted(spark, sf, "domains")
    new = table(spark, sf, "orders").select(F.concat(F.lit("n"), F.col("o_custkey") % 500, F.lit(".ru")).alias("domain"))
    known.select("domain").unionByName(new).write.option("header", True).csv(path)
    return load_domains(known, path)


SQL_LOAD_INNS = """WITH e AS (SELECT s_suppkey AS id, lpad(CAST(s_suppkey AS STRING), 10, '0') AS inn, CAST(s_nationkey AS BIGINT) AS domain_id FROM supplier),
    r AS (SELECT DISTINCT lpad(CAST(o_custkey AS STRING), 10, '0') AS inn FROM orders) """


def _load_inns(spark, sf):
    path = _scratch(spark, "inns-csv")
    known = table(spark, sf, "supplier").selectExpr("s_suppkey AS id", "lpad(CAST(s_suppkey AS STRING), 10, '0') AS inn", "CAST(s_nationkey AS BIGINT) AS domain_id")
    inn = F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("inn")
    table(spark, sf, "orders").select(inn).write.option("header", True).csv(path)
    return load_inns(known, path)


@register("plan_load_inns", SQL_LOAD_INNS + """SELECT id, inn, domain_id FROM e UNION ALL SELECT (SELECT max(id) FROM e) + row_number() OVER (ORDER BY inn), inn, NULL
    FROM r WHERE inn NOT IN (SELECT inn FROM e)""")
def _(spark, sf):
    return _load_inns(spark, sf)[0]


@register("plan_load_inns_known", SQL_LOAD_INNS + "SELECT inn FROM r WHERE inn IN (SELECT inn FROM e)")
def _(spark, sf):
    return _load_inns(spark, sf)[1]


@register("plan_load_domain_inns", planted_sql("inn_rows") + """, e AS (SELECT s_suppkey AS id, s_name AS inn, s_suppkey AS domain_id FROM supplier),
    n AS (SELECT domain_id, min(inn) AS inn FROM inn_rows WHERE domain_id IS NOT NULL AND domain_id NOT IN (SELECT domain_id FROM e) GROUP BY domain_id)
    SELECT id, inn, domain_id FROM e UNION ALL SELECT (SELECT max(id) FROM e) + row_number() OVER (ORDER BY domain_id), inn, domain_id FROM n""")
def _(spark, sf):
    path = _scratch(spark, "inn-arrays")
    known = table(spark, sf, "supplier").selectExpr("s_suppkey AS id", "s_name AS inn", "s_suppkey AS domain_id")
    sources.write_json_arrays(planted(spark, sf, "inn_rows").repartition(8, "inn"), path)
    return load_domain_inns(known, path)
