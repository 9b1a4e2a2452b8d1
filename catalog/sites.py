"""Lookups, classification, status rules and the crawl job (J, C, ST, plans)."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteledger import sources
from siteledger.operators import (
    Rule,
    attempt_code,
    category_tags,
    classify_pages,
    clean_domain_info,
    deal_properties,
    delete_where,
    extract_features,
    inn_regions,
    merge_contact_pages,
    page_status,
    phone_locations,
    resolve_status,
    shared_dir,
    shop_flags,
    split_valid,
    status_counts,
)
from siteledger.functions import strip_hidden, text, title
from siteledger.plans import clean_up, crawl, read_pages
from siteledger.schemas import PAGE_FETCH, TABLES
from siteledger.streaming import refresh_tables, site_table, stream_pages

from . import register, table, texts
from .planted import TITLE, planted, planted_sql
from .reports import SQL_IS_PAGE, SQL_SITE_HIT
from .text import SQL_PLANTED_INNS, SQL_PLANTED_PHONES, sql_clean, sql_decode, sql_markup, sql_text

# A short rule list whose words occur in the page table.
RULES = [
    Rule("url", 0, 4300, "spam-farm", False),
    Rule("title", 1, 1000, "the"),
    Rule("title", 2, 1100, "und"),
    Rule("content", 3, 3000, "Ohne"),
    Rule("content", 4, 3100, "que"),
    Rule("content", 5, 3100, "des"),
]


def _sql_word(expr: str, word: str) -> str:
    other = r"[^\p{L}\p{M}\p{N}_]"
    return f"regexp_matches(lower({expr}), '(^|{other}){word}({other}|$)')"


def _sql_pages() -> str:
    t = sql_clean(sql_decode(f"regexp_extract({sql_markup('html')}, '(?is)<title[^>]*>(.*?)</title', 1)"))
    return f"""WITH p AS (SELECT page_id, url, {t} AS title, {sql_text('html')} AS text FROM pages),
        s AS (SELECT page_id, CASE WHEN contains(lower(url), 'spam-farm') THEN 4300 WHEN {_sql_word('title', 'the')} THEN 1000
        WHEN {_sql_word('title', 'und')} THEN 1100 WHEN {_sql_word('text', 'ohne')} THEN 3000
        WHEN {_sql_word('text', 'que')} OR {_sql_word('text', 'des')} THEN 3100 END AS status,
        CASE WHEN contains(lower(url), 'spam-farm') THEN 'spam-farm' WHEN {_sql_word('title', 'the')} THEN '\\bthe\\b'
        WHEN {_sql_word('title', 'und')} THEN '\\bund\\b' WHEN {_sql_word('text', 'ohne')} THEN '\\bohne\\b'
        WHEN {_sql_word('text', 'que')} THEN '\\bque\\b' WHEN {_sql_word('text', 'des')} THEN '\\bdes\\b' END AS banword FROM p) """


def classified_pages(spark, sf):
    pages = texts(spark, sf, "pages", "page_id", "url", "html").select("page_id", F.col("url").alias("real_url"), strip_hidden(F.col("html")).alias("m"))
    pages = pages.select("page_id", "real_url", title(F.col("m")).alias("title"), text(F.col("m")).alias("text"))
    return classify_pages(pages, RULES, description=F.lit(""))


@register("c1_classify_pages", _sql_pages() + "SELECT page_id, CAST(status AS INT) AS junk_status, banword FROM s")
def _(spark, sf):
    return classified_pages(spark, sf).select("page_id", "junk_status", "banword")


@register("flagship_page_status_counts", _sql_pages() + "SELECT CAST(coalesce(status, 200) AS INT) AS status, count(*) AS count FROM s GROUP BY 1")
def page_status_counts(spark, sf):
    """Title, text and rules over all pages, counted per status."""
    status = F.coalesce("junk_status", F.lit(200)).alias("status")
    return status_counts(classified_pages(spark, sf).select(status))


SQL_JUNK = """CASE WHEN contains(real_url, 'porn') THEN 4200 WHEN domain_id % 11 = 3 THEN 1000 WHEN domain_id % 13 = 5 THEN 1100
    WHEN domain_id % 19 = 4 AND domain_id % 2 = 0 THEN 3200 END"""
SQL_PAGE_STATUS = f"CASE WHEN {SQL_JUNK} IS NULL THEN 200 WHEN domain_id % 7 = 3 THEN 228 ELSE {SQL_JUNK} END"


@register("c2_default_rules", planted_sql("page_fetch") + f"""SELECT domain_id, CAST({SQL_JUNK} AS INT) AS junk_status,
    CASE {SQL_JUNK} WHEN 4200 THEN 'porn' WHEN 1000 THEN '\\b404\\b' WHEN 1100 THEN '\\bкупить домен\\b'
    WHEN 3200 THEN '\\baccount has been suspended\\b' END AS banword FROM page_fetch""")
def _(spark, sf):
    pages = extract_features(planted(spark, sf, "page_fetch"))
    return classify_pages(pages).select("domain_id", "junk_status", "banword")


@register("c3_junk_bitrix", planted_sql("page_fetch") + f"SELECT domain_id, CAST({SQL_PAGE_STATUS} AS INT) AS page_status FROM page_fetch")
def _(spark, sf):
    pages = extract_features(planted(spark, sf, "page_fetch"))
    return page_status(classify_pages(pages)).select("domain_id", "page_status")


@register("c4_valid_pages", planted_sql("page_fetch") + f"SELECT domain_id, real_url FROM page_fetch WHERE {SQL_IS_PAGE} AND {SQL_PAGE_STATUS} = 200")
def _(spark, sf):
    return split_valid(read_pages(planted(spark, sf, "page_fetch")))[0].select("domain_id", "real_url")


@register("c4_junk_pages", planted_sql("page_fetch") + f"""SELECT domain_id, real_url, CAST({SQL_PAGE_STATUS} AS INT) AS page_status
    FROM page_fetch WHERE {SQL_IS_PAGE} AND {SQL_PAGE_STATUS} <> 200""")
def _(spark, sf):
    return split_valid(read_pages(planted(spark, sf, "page_fetch")))[1].select("domain_id", "real_url", "page_status")


@register("c5_clean_domain_info", planted_sql("site_info") + f"SELECT id, domain_id, real_domain, title FROM site_info WHERE NOT {SQL_SITE_HIT}")
def _(spark, sf):
    return clean_domain_info(planted(spark, sf, "site_info"))[0].select("id", "domain_id", "real_domain", "title")


@register("c6_error_status", planted_sql("attempts") + """SELECT seq, CAST(CASE error_kind WHEN 'timeout' THEN 408 WHEN 'disconnect' THEN 800
    WHEN 'connect' THEN 404 WHEN 'ssl' THEN NULL ELSE CASE WHEN http_status NOT IN (0, 200) THEN http_status END END AS INT) AS code FROM attempts""")
def _(spark, sf):
    return planted(spark, sf, "attempts").select("seq", attempt_code(F.col("http_status"), F.col("error_kind")).alias("code"))


# A plain fold over each domain's attempts in order: the state is (status,
# address); pages always replace it, codes only when the status is not 200.
SQL_FOLD = planted_sql("attempts", "domains") + """, e AS (SELECT domain_id, list({
        'kind': CASE WHEN error_kind IS NULL AND http_status = 200 THEN 'page' WHEN error_kind = 'ssl' OR http_status = 0 THEN 'none' ELSE 'code' END,
        'status': CASE WHEN error_kind IS NULL AND http_status = 200 THEN page_status WHEN error_kind = 'timeout' THEN 408
            WHEN error_kind = 'disconnect' THEN 800 WHEN error_kind = 'connect' THEN 404 ELSE http_status END,
        'url': CASE WHEN error_kind IS NULL AND http_status = 200 THEN real_url ELSE '' END} ORDER BY seq) AS l
    FROM attempts GROUP BY domain_id),
    f AS (SELECT id, domain, zone, list_reduce(list_concat([{'kind': 'start', 'status': status, 'url': real_domain}], coalesce(l, [])),
        lambda s, x: CASE WHEN x.kind = 'page' OR (x.kind = 'code' AND s.status <> 200) THEN x ELSE s END) AS s
    FROM domains LEFT JOIN e ON id = domain_id)
    SELECT id, domain, zone, s.url AS real_domain, s.status AS status FROM f"""


@register("c7_resolve_status", SQL_FOLD)
def _(spark, sf):
    return resolve_status(planted(spark, sf, "domains"), planted(spark, sf, "attempts"))


@register("j1_category_tags", """SELECT r_name AS category_name, n_name AS subcategory_name, c_name AS tag, c_custkey AS tag_id
    FROM nation LEFT JOIN region ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey""")
def _(spark, sf):
    category = table(spark, sf, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    sub = table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("category_id"))
    tags = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("tag"), F.col("c_nationkey").alias("subcategory_id"))
    return category_tags(category, sub, tags)


@register("j2_inn_regions", """SELECT l_orderkey AS domain_id, lpad(CAST(l_partkey * 7919 + l_suppkey AS STRING), 10, '0') AS inn, n_name AS region
    FROM lineitem JOIN nation ON CAST(substr(lpad(CAST(l_partkey * 7919 + l_suppkey AS STRING), 10, '0'), 1, 2) AS INT) = n_nationkey""")
def _(spark, sf):
    inns = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("domain_id"),
        F.lpad((F.col("l_partkey") * 7919 + F.col("l_suppkey")).cast("string"), 10, "0").alias("inn"),
    )
    regions = table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.concat(F.lit(" "), "n_name").alias("region"))
    return inn_regions(inns, regions)


# Prefixes of one to eight digits out of the nation and supplier tables.
_PREFIXES = [
    ("nation", "'7' || lpad(CAST(n_nationkey AS STRING), 1 + n_nationkey % 3, '4')", "n_name"),
    ("supplier", "'7' || substr(lpad(CAST(s_suppkey * 7919003 % 1000000000 AS STRING), 10, '4'), 1, CAST(3 + s_suppkey % 5 AS INT))", "s_name"),
]


def _prefixes(spark, sf):
    a, b = (table(spark, sf, t).selectExpr(f"{p} AS prefix", f"{n} AS location") for t, p, n in _PREFIXES)
    return a.unionByName(b)


SQL_PREFIXES = "prefixes AS (" + " UNION ALL ".join(f"SELECT {p} AS prefix, {n} AS location FROM {t}" for t, p, n in _PREFIXES) + ")"


@register("j3_phone_locations", planted_sql("phones") + f""", {SQL_PREFIXES}, one AS (SELECT prefix, min(location) AS location FROM prefixes GROUP BY prefix)
    SELECT domain_id, number, arg_max(location, length(prefix)) AS location FROM phones JOIN one
    ON starts_with('7' || substr(number, 2), prefix) GROUP BY domain_id, number""")
def _(spark, sf):
    return phone_locations(planted(spark, sf, "phones"), _prefixes(spark, sf))


SQL_CONTACTS = """, c AS (SELECT domain_id, bool_or(failed) AS failed,
    list(DISTINCT 'c' || (o_orderkey % 50) || '@shop.ru') FILTER (WHERE o_orderstatus <> 'P' AND NOT failed) AS e,
    list(DISTINCT '8800' || lpad(CAST(o_orderkey % 90 AS STRING), 7, '0')) FILTER (WHERE o_orderstatus <> 'P' AND NOT failed) AS t
    FROM (SELECT o_custkey AS domain_id, o_orderkey, o_orderstatus, o_orderkey % 53 = 9 AS failed FROM orders) GROUP BY domain_id) """


@register("j4_merge_contact_pages", planted_sql("page_fetch") + SQL_CONTACTS + """, m AS (SELECT domain_id,
    CASE WHEN domain_id % 2 = 1 THEN ['u' || domain_id || '@ex' || (domain_id % 7) || '.com'] WHEN domain_id % 6 = 0 THEN ['Info' || domain_id || '@Firm.co.uk'] ELSE [] END AS emails
    FROM page_fetch), more AS (SELECT m.domain_id, e, t FROM m JOIN c ON m.domain_id = c.domain_id WHERE len(emails) = 0 AND NOT failed)
    SELECT domain_id, 'emails' AS kind, unnest(emails) AS value FROM m UNION SELECT domain_id, 'emails', unnest(e) FROM more
    UNION SELECT domain_id, 'phones', unnest(t) FROM more UNION SELECT c_custkey, 'inns', unnest(%s) FROM customer UNION SELECT c_custkey, 'phones',
    unnest(string_split(%s, ',')) FROM customer WHERE %s <> ''""".replace("%s", "{}").format(
    SQL_PLANTED_INNS, SQL_PLANTED_PHONES, SQL_PLANTED_PHONES))
def _(spark, sf):
    main = extract_features(planted(spark, sf, "page_fetch")).select("domain_id", "emails", "phones", "inns")
    return merge_contact_pages(main, planted(spark, sf, "contact_pages"))


SQL_PROBES = """, pr AS (SELECT domain_id,
    coalesce(bool_or(probe_group = 'cart' AND status = 200), false) AND NOT bool_or(probe_group = 'cart' AND failed) AS cart,
    coalesce(bool_or(probe_group = 'catalog' AND status = 200), false) AND NOT bool_or(probe_group = 'catalog' AND failed) AS catalog
    FROM probes GROUP BY domain_id) """


@register("j5_shop_flags", planted_sql("page_fetch", "probes") + SQL_PROBES + """SELECT p.domain_id,
    p.domain_id % 7 = 3 AND coalesce(cart, false) AS is_ecommerce, p.domain_id % 7 = 3 AND coalesce(cart OR catalog, false) AS has_catalog
    FROM page_fetch p LEFT JOIN pr ON p.domain_id = pr.domain_id""")
def _(spark, sf):
    sites = extract_features(planted(spark, sf, "page_fetch")).select("domain_id", "cms", "title", "real_url")
    return shop_flags(sites, planted(spark, sf, "probes")).select("domain_id", "is_ecommerce", "has_catalog")


@register("j6_deal_properties", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def _(spark, sf):
    ids = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return deal_properties(ids, table(spark, sf, "orders"), "o_orderkey").select("o_orderkey", "o_custkey", "o_totalprice")


@register("j7_delete_where", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def _(spark, sf):
    ids = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return delete_where(table(spark, sf, "orders"), ids, "o_orderkey").select("o_orderkey", "o_custkey")


def _regions(spark, sf):
    return table(spark, sf, "nation").select((F.col("n_nationkey") + 40).alias("id"), F.col("n_name").alias("region"))


def _start_tables(spark, sf):
    empty = {n: spark.createDataFrame([], TABLES[n]) for n in ("domain_info", "domain_phones", "domain_emails", "domain_inns", "inns")}
    return {"domains": planted(spark, sf, "domains"), **empty}


def _crawl(spark, sf, **more):
    return crawl(_start_tables(spark, sf), planted(spark, sf, "page_fetch"), regions=_regions(spark, sf), run_date="2024-05-01", **more)


SQL_CRAWL_DOMAINS = planted_sql("page_fetch", "domains") + f"""SELECT d.id, d.domain, d.zone,
    CASE WHEN {SQL_IS_PAGE} THEN real_url WHEN d.status <> 200 AND (error_kind = 'timeout' OR http_status = 503) THEN '' ELSE d.real_domain END AS real_domain,
    CAST(CASE WHEN {SQL_IS_PAGE} THEN {SQL_PAGE_STATUS} WHEN d.status <> 200 AND error_kind = 'timeout' THEN 408
    WHEN d.status <> 200 AND http_status = 503 THEN 503 ELSE d.status END AS INT) AS status
    FROM domains d JOIN page_fetch p ON d.id = p.domain_id"""


@register("plan_crawl_domains", SQL_CRAWL_DOMAINS)
def _(spark, sf):
    return _crawl(spark, sf)["domains"]


SQL_VALID = f"""v AS (SELECT *, list_sort({SQL_PLANTED_INNS.replace('c_custkey', 'domain_id')}) AS inns FROM page_fetch WHERE {SQL_IS_PAGE} AND {SQL_PAGE_STATUS} = 200)"""


@register("plan_crawl_domain_info", planted_sql("page_fetch", "probes") + f""", {SQL_VALID} {SQL_PROBES}, r AS (SELECT v.domain_id, real_url AS real_domain, seq,
    {sql_clean(sql_decode(TITLE)).replace('c_custkey', 'v.domain_id')} AS title, array_to_string(inns, ',') AS inn,
    CASE WHEN v.domain_id % 7 = 3 THEN 'Bitrix' WHEN v.domain_id % 5 = 2 THEN 'Wordpress' ELSE '' END AS cms, ip,
    contains(coalesce(https_real_url, real_url), 'https://') AS is_ssl, contains(real_url, 'www.') AS is_www,
    v.domain_id % 7 = 3 AND coalesce(cart, false) AS is_ecommerce, v.domain_id % 7 = 3 AND coalesce(cart OR catalog, false) AS has_catalog
    FROM (SELECT v.*, c_name FROM v JOIN customer ON c_custkey = v.domain_id) v LEFT JOIN pr ON v.domain_id = pr.domain_id),
    o AS (SELECT real_domain, arg_min(domain_id, seq) AS domain_id, arg_max(r, seq) AS w FROM r GROUP BY real_domain)
    SELECT row_number() OVER (ORDER BY domain_id) AS id, domain_id, real_domain, w.title AS title, w.inn AS inn, w.cms AS cms, w.ip AS ip,
    w.is_ssl AS is_ssl, w.is_www AS is_www, w.is_ecommerce AS is_ecommerce, w.has_catalog AS has_catalog, 0 AS tag_id FROM o""")
def _(spark, sf):
    info = _crawl(spark, sf, probes=planted(spark, sf, "probes"))["domain_info"]
    return info.select(
        "id", "domain_id", "real_domain", "title", "inn", "cms", "ip", "is_ssl", "is_www", "is_ecommerce", "has_catalog", "tag_id"
    )


@register("plan_crawl_emails", planted_sql("page_fetch") + SQL_CONTACTS + f""", {SQL_VALID}, m AS (SELECT domain_id,
    CASE WHEN domain_id % 2 = 1 THEN ['u' || domain_id || '@ex' || (domain_id % 7) || '.com'] WHEN domain_id % 6 = 0 THEN ['Info' || domain_id || '@Firm.co.uk'] ELSE [] END AS emails FROM v)
    SELECT domain_id, email FROM (SELECT m.domain_id, unnest(CASE WHEN len(emails) = 0 AND NOT failed THEN coalesce(e, []) ELSE emails END) AS email
    FROM m LEFT JOIN c ON m.domain_id = c.domain_id)""")
def _(spark, sf):
    return _crawl(spark, sf, contact_pages=planted(spark, sf, "contact_pages"))["domain_emails"].select("domain_id", "email")


@register("plan_crawl_inns", planted_sql("page_fetch") + f", {SQL_VALID} SELECT x.inn, max(domain_id) AS domain_id FROM (SELECT domain_id, unnest(inns) AS inn FROM v) x GROUP BY x.inn")
def _(spark, sf):
    return _crawl(spark, sf)["inns"].select("inn", "domain_id")


SQL_MAIN_MAILS = f"""m AS (SELECT domain_id, CASE WHEN domain_id % 2 = 1 THEN ['u' || domain_id || '@ex' || (domain_id % 7) || '.com']
    WHEN domain_id % 6 = 0 THEN ['Info' || domain_id || '@Firm.co.uk'] ELSE [] END AS emails FROM v)"""
SQL_MAIN_PHONES = f"""SELECT c_custkey AS domain_id, unnest(string_split({SQL_PLANTED_PHONES}, ',')) AS number FROM customer
    WHERE {SQL_PLANTED_PHONES} <> '' AND c_custkey IN (SELECT domain_id FROM v)"""


@register("plan_crawl_phones", planted_sql("page_fetch") + SQL_CONTACTS + f""", {SQL_VALID}, {SQL_MAIN_MAILS} {SQL_MAIN_PHONES}
    UNION SELECT m.domain_id, unnest(t) FROM m JOIN c ON m.domain_id = c.domain_id WHERE len(emails) = 0 AND NOT failed""")
def _(spark, sf):
    return _crawl(spark, sf, contact_pages=planted(spark, sf, "contact_pages"))["domain_phones"].select("domain_id", "number")


@register("plan_crawl_domain_inns", planted_sql("page_fetch") + f""", {SQL_VALID} SELECT row_number() OVER (ORDER BY domain_id) AS id,
    list_min(inns) AS inn, domain_id FROM v WHERE len(inns) > 0""")
def _(spark, sf):
    return _crawl(spark, sf)["domain_inns"].select("id", "inn", "domain_id")


SQL_INFO_TEXTS = planted_sql("page_fetch") + f""", {SQL_VALID}, {SQL_PREFIXES}, one AS (SELECT prefix, min(location) AS location FROM prefixes GROUP BY prefix),
    ph AS ({SQL_MAIN_PHONES}), loc AS (SELECT domain_id, number, arg_max(location, length(prefix)) AS location FROM ph JOIN one
    ON starts_with('7' || substr(number, 2), prefix) GROUP BY domain_id, number), byphone AS (SELECT domain_id, string_agg(DISTINCT location, ',' ORDER BY location) AS city FROM loc GROUP BY domain_id),
    byinn AS (SELECT domain_id, string_agg(n_name, ',' ORDER BY n_name) AS city FROM (SELECT domain_id, unnest(inns) AS inn FROM v) JOIN nation
    ON CAST(substr(inn, 1, 2) AS INT) = n_nationkey + 40 GROUP BY domain_id),
    r AS (SELECT v.domain_id, real_url AS real_domain, seq, coalesce(CASE WHEN len(inns) > 0 THEN i.city ELSE p.city END, '') AS city, c_mktsegment || ' > all' AS description,
    CASE WHEN v.domain_id % 4 = 1 THEN trim(repeat(c_mktsegment || ', ', 150)) ELSE '' END AS keywords, contains(real_url, 'https://') AS is_https_redirect
    FROM v JOIN customer ON c_custkey = v.domain_id LEFT JOIN byinn i ON i.domain_id = v.domain_id LEFT JOIN byphone p ON p.domain_id = v.domain_id),
    o AS (SELECT real_domain, arg_min(domain_id, seq) AS domain_id, arg_max(r, seq) AS w FROM r GROUP BY real_domain)
    SELECT domain_id, w.city AS city, w.description AS description, w.keywords AS keywords, '' AS hosting, w.is_https_redirect AS is_https_redirect,
    DATE '2024-05-01' AS last_updated, '' AS country, '' AS license_type, 'Отсутствует' AS status FROM o"""
INFO_TEXTS = ["domain_id", "city", "description", "keywords", "hosting", "is_https_redirect", "last_updated", "country", "license_type", "status"]


@register("plan_crawl_info_texts", SQL_INFO_TEXTS)
def _(spark, sf):
    """Texts of the sites and their cities, by tax id or else by phone number."""
    return _crawl(spark, sf, prefixes=_prefixes(spark, sf))["domain_info"].select(*INFO_TEXTS)


@register("plan_clean_up_records", planted_sql("site_info") + f"SELECT id, real_domain FROM site_info WHERE {SQL_SITE_HIT}")
def _(spark, sf):
    return clean_up(planted(spark, sf, "site_info"))[1].select("id", "real_domain")


def _stream(spark, sf, **more):
    """The crawl as a stream of files: feature log, then one refresh; gives the folder of the tables."""
    base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    pages = planted(spark, sf, "page_fetch")
    pages.select(*[F.col(f.name).cast(f.dataType) for f in PAGE_FETCH.fields]).repartition(4, "domain_id").write.parquet(f"{base}/feed")
    site_table(spark, f"{base}/root", "domains").replace(planted(spark, sf, "domains"))
    stream_pages(spark, f"{base}/feed", f"{base}/root", f"{base}/checkpoint", max_files=2)
    refresh_tables(spark, f"{base}/root", regions=_regions(spark, sf), run_date="2024-05-01", **more)
    return f"{base}/root"


@register("st1_stream_domains", SQL_CRAWL_DOMAINS)
def _(spark, sf):
    return site_table(spark, _stream(spark, sf), "domains").read()


@register("st1_stream_contacts", planted_sql("page_fetch") + f""", {SQL_VALID}, {SQL_MAIN_MAILS}
    SELECT domain_id, 'emails' AS kind, unnest(emails) AS value FROM m UNION ALL SELECT domain_id, 'phones', number FROM ({SQL_MAIN_PHONES})
    UNION ALL SELECT domain_id, 'domain_inns', list_min(inns) FROM v WHERE len(inns) > 0
    UNION ALL SELECT max(domain_id), 'inns', inn FROM (SELECT domain_id, unnest(inns) AS inn FROM v) GROUP BY inn""")
def _(spark, sf):
    """All contact tables of the streamed crawl, one after the other."""
    root, rows = _stream(spark, sf), []
    kinds = (("domain_emails", "emails", "email"), ("domain_phones", "phones", "number"), ("domain_inns", "domain_inns", "inn"), ("inns", "inns", "inn"))
    for name, kind, value in kinds:
        rows.append(site_table(spark, root, name).read().select("domain_id", F.lit(kind).alias("kind"), F.col(value).alias("value")))
    return reduce(DataFrame.unionByName, rows)


@register("st1_stream_info", SQL_INFO_TEXTS)
def _(spark, sf):
    """Texts and cities of the sites of the streamed crawl."""
    root = _stream(spark, sf, prefixes=_prefixes(spark, sf))
    return site_table(spark, root, "domain_info").read().select(*INFO_TEXTS)
