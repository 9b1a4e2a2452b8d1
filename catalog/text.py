"""Extraction queries (T)."""

from __future__ import annotations

from pyspark.sql import functions as F

from siteledger import functions as fn
from siteledger.functions.contacts import EMAIL
from siteledger.operators import category_votes, extract_features, identify_category, region_names

from . import register, table, texts
from .planted import HTML, INN10, INN12, TITLE, planted

# The same patterns as the Column functions, written for the checking engine.
SQL_HIDDEN = r"(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<!--.*?-->"
SQL_TAG = r"""(?s)<[/!?a-zA-Z](?:[^>"'']|"[^"]*"|''[^'']*'')*>|<[/!?a-zA-Z][^>]*>"""
SQL_PHONE = r"\+?[78][\s(-]{0,2}[0-9]{3,4}[\s)]?[\s-]?[0-9\s-]{0,4}[0-9\s-]{0,5}"


# References that occur in the page table and in the derived pages.
SQL_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&nbsp;": "\u00a0", "&copy;": "©", "&middot;": "·", "&amp;": "&"}


def sql_decode(expr: str) -> str:
    for entity, char in SQL_ENTITIES.items():
        expr = f"replace({expr}, '{entity}', '{char}')"
    return expr


def sql_clean(expr: str) -> str:
    return f"trim(translate({expr}, chr(10) || chr(34) || chr(39) || chr(92), ''), ' ' || chr(9) || chr(10) || chr(13))"


def sql_markup(html: str) -> str:
    return f"regexp_replace({html}, '{SQL_HIDDEN}', '', 'g')"


def sql_text(html: str) -> str:
    return sql_decode(f"regexp_replace({sql_markup(html)}, '{SQL_TAG}', '', 'g')")


def sql_set(values: str) -> str:
    """Sorted distinct list as one string."""
    return f"array_to_string(list_sort(list_distinct({values})), ',')"


def sql_emails(text: str) -> str:
    found = f"list_transform(regexp_extract_all({text}, '{EMAIL}'), lambda e: trim(e, chr(34) || chr(39) || '.,'))"
    return sql_set(found)


def sql_phones(text: str) -> str:
    digits = f"list_transform(regexp_extract_all({text}, '{SQL_PHONE}'), lambda n: regexp_replace(n, '[^0-9]', '', 'g'))"
    return sql_set(f"list_filter({digits}, lambda n: regexp_full_match(n, '[78][0-9]{{10}}'))")


def sql_valid_inn(inn: str) -> str:
    def check(weights, at):
        total = " + ".join(f"CAST(substr({inn}, {i}, 1) AS INT) * {w}" for i, w in enumerate(weights, 1))
        return f"({total}) % 11 = CAST(substr({inn}, {at}, 1) AS INT)"

    ten = check([2, 4, 10, 3, 5, 9, 4, 6, 8], 10)
    eleven, twelve = check([7, 2, 4, 10, 3, 5, 9, 4, 6, 8], 11), check([3, 7, 2, 4, 10, 3, 5, 9, 4, 6, 8], 12)
    return f"(CASE WHEN length({inn}) = 10 THEN {ten} WHEN length({inn}) = 12 THEN {eleven} AND {twelve} ELSE false END)"


@register("t1_title", f"""SELECT page_id, {sql_clean(sql_decode(f"regexp_extract({sql_markup('html')}, '(?is)<title[^>]*>(.*?)</title', 1)"))} AS title FROM pages""")
def _(spark, sf):
    return texts(spark, sf, "pages", "page_id", "html").select("page_id", fn.title(fn.strip_hidden(F.col("html"))).alias("title"))


@register("t1_title_planted", f"SELECT c_custkey AS domain_id, {sql_clean(sql_decode(TITLE))} AS title FROM customer")
def _(spark, sf):
    return planted(spark, sf, "page_fetch").select("domain_id", fn.title(fn.strip_hidden(F.col("html"))).alias("title"))


@register("t2_description", "SELECT c_custkey AS domain_id, c_mktsegment || ' > all' AS description FROM customer")
def _(spark, sf):
    return planted(spark, sf, "page_fetch").select("domain_id", fn.description(fn.meta_tags(F.col("html"))).alias("description"))


@register("t3_keywords", """SELECT c_custkey AS domain_id, CASE WHEN c_custkey % 4 = 1
    THEN trim(repeat(c_mktsegment || ', ', 150)) ELSE '' END AS keywords FROM customer""")
def _(spark, sf):
    return planted(spark, sf, "page_fetch").select("domain_id", fn.keywords(fn.meta_tags(F.col("html"))).alias("keywords"))


@register("t4_text", f"SELECT page_id, {sql_text('html')} AS text FROM pages")
def _(spark, sf):
    return texts(spark, sf, "pages", "page_id", "html").select("page_id", fn.text(fn.strip_hidden(F.col("html"))).alias("text"))


@register("t4_text_planted", "SELECT c_custkey AS domain_id, 'ab A c A &; xz' || c_name AS text FROM customer")
def _(spark, sf):
    """Templates and ruby annotations are no text; numeric references need no semicolon and may have leading zeros."""
    html = F.concat(
        F.lit("a<template>hid"), "c_custkey", F.lit("@x.ru</template>b &#65 c &#0000000065; &amp;; <ruby>x<rt>y<rt>w</rt><rp>(</rp></ruby>z"), "c_name"
    )
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("domain_id"), fn.text(fn.strip_hidden(html)).alias("text"))


@register("t5_links", f"""WITH a AS (SELECT page_id, regexp_extract_all({sql_markup('html')}, '(?is)<a\\s[^>]*>.*?</a\\s*>') AS l FROM pages)
    SELECT page_id, array_to_string(list_transform(l, lambda x: regexp_extract(x, 'href="([^"]*)"', 1) || ' ' ||
    regexp_replace(x, '<[^>]*>', '', 'g')), '|') AS links, CAST(len(l) AS INT) AS n FROM a""")
def _(spark, sf):
    pages = texts(spark, sf, "pages", "page_id", "html").select("page_id", fn.links(fn.strip_hidden(F.col("html"))).alias("l"))
    joined = F.array_join(F.transform("l", lambda a: F.concat(a["href"], F.lit(" "), a["text"])), "|")
    return pages.select("page_id", joined.alias("links"), F.size("l").alias("n"))


@register("t6_emails", f"SELECT doc_id, {sql_emails('text')} AS emails FROM documents")
def _(spark, sf):
    no_links = F.array().cast("array<struct<href string, text string>>")
    return texts(spark, sf, "documents", "doc_id", "text").select("doc_id", fn.sorted_csv(fn.emails(F.col("text"), no_links)).alias("emails"))


@register("t6_emails_planted", """SELECT c_custkey AS domain_id,
    CASE WHEN c_custkey % 2 = 1 THEN 'u' || c_custkey || '@ex' || (c_custkey % 7) || '.com'
         WHEN c_custkey % 6 = 0 THEN 'Info' || c_custkey || '@Firm.co.uk' ELSE '' END AS emails FROM customer""")
def _(spark, sf):
    return extract_features(planted(spark, sf, "page_fetch")).select("domain_id", fn.sorted_csv(F.col("emails")).alias("emails"))


@register("t7_phones", f"SELECT doc_id, {sql_phones('text')} AS phones FROM documents")
def _(spark, sf):
    no_links = F.array().cast("array<struct<href string, text string>>")
    return texts(spark, sf, "documents", "doc_id", "text").select("doc_id", fn.sorted_csv(fn.phones(F.col("text"), no_links)).alias("phones"))


SQL_PLANTED_PHONES = sql_phones(
    "(" + sql_text(HTML) + " || CASE WHEN c_custkey % 3 = 1 THEN ' x +7 (495) 123-' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0') ELSE '' END)"
)


@register("t7_phones_planted", f"SELECT c_custkey AS domain_id, {SQL_PLANTED_PHONES} AS phones FROM customer")
def _(spark, sf):
    return extract_features(planted(spark, sf, "page_fetch")).select("domain_id", fn.sorted_csv(F.col("phones")).alias("phones"))


@register("t8_inn_checksum", f"""WITH i AS (SELECT o_orderkey, lpad(CAST(o_orderkey AS STRING), 10, '0') AS a,
    lpad(CAST(o_orderkey * 104729 + 500100000000 AS STRING), 12, '0') AS b FROM orders)
    SELECT o_orderkey, {sql_valid_inn('a')} AS ok10, {sql_valid_inn('b')} AS ok12 FROM i""")
def _(spark, sf):
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        fn.is_valid_inn(F.lpad(key.cast("string"), 10, "0")).alias("ok10"),
        fn.is_valid_inn(F.lpad((key * 104729 + 500100000000).cast("string"), 12, "0")).alias("ok12"),
    )


SQL_PLANTED_INNS = f"""list_filter([CASE WHEN c_custkey % 4 = 0 THEN {INN10} END, CASE WHEN c_custkey % 6 = 2 THEN {INN12} END],
    lambda i: i IS NOT NULL AND {sql_valid_inn('i')})"""


@register("t8_inns", f"SELECT c_custkey AS domain_id, {sql_set(SQL_PLANTED_INNS)} AS inns FROM customer")
def _(spark, sf):
    return extract_features(planted(spark, sf, "page_fetch")).select("domain_id", fn.sorted_csv(F.col("inns")).alias("inns"))


# The tag list is a parameter of the job; these words occur in the documents.
TAGS = [(1, "the, of, and, of"), (2, "que, de, la, été"), (3, "und, der, die"), (5, "in the, to the")]


# 87 rows with 17 words each, as long as real lists: two syllables of the documents after each other.
_SYLLABLES = "the an er on en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic ne ea ra ce li ch".split()
LONG_TAGS = [
    (i, ", ".join(_SYLLABLES[(i + k) % 40] + _SYLLABLES[(i * 7 + k * 3) % 40] for k in range(17))) for i in range(1, 88)
]


def _tags(spark, tags=TAGS):
    return spark.createDataFrame(tags, "id int, tag string")


def _sql_votes() -> str:
    """Votes by plain counting; blanks and the like are doubled so that phrases cannot share one."""
    texts = r"(SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{M}\p{N}_]+') AS w, ' ' || regexp_replace(text, '([^\p{L}\p{M}\p{N}_])', '\1\1', 'g') || ' ' AS t FROM documents)"
    votes = []
    for tag_id, tags in TAGS:
        counts = []
        for tag in (t.strip() for t in tags.split(",")):
            if " " in tag:
                spread = tag.replace(" ", "  ")
                counts.append(rf"len(regexp_extract_all(t, '[^\p{{L}}\p{{M}}\p{{N}}_]{spread}[^\p{{L}}\p{{M}}\p{{N}}_]'))")
            else:
                counts.append(f"len(list_filter(w, lambda x: x = '{tag}'))")
        votes.append(f"SELECT doc_id, {tag_id} AS tag_id, CAST({' + '.join(counts)} AS BIGINT) AS votes FROM texts")
    return f"WITH texts AS {texts}, votes AS (" + " UNION ALL ".join(votes) + ") "


@register("t9_category_votes", _sql_votes() + "SELECT doc_id, CAST(tag_id AS INT) AS tag_id, votes FROM votes WHERE votes > 0")
def _(spark, sf):
    votes = category_votes(texts(spark, sf, "documents", "doc_id", "text"), _tags(spark), F.col("text"), "doc_id")
    return votes.where(F.col("tag_id").isNotNull())


@register("t9_identify_category", _sql_votes() + """SELECT doc_id, CAST(CASE WHEN max(votes) = 0 THEN 0 ELSE
    min(tag_id) FILTER (WHERE votes = m) END AS INT) AS tag_id FROM
    (SELECT *, max(votes) OVER (PARTITION BY doc_id) AS m FROM votes) GROUP BY doc_id""")
def _(spark, sf):
    return identify_category(texts(spark, sf, "documents", "doc_id", "text"), _tags(spark), F.col("text"), "doc_id")


_SQL_LONG = "(VALUES " + ", ".join(f"({i}, '{word.strip()}')" for i, words in LONG_TAGS for word in words.split(",")) + ") AS l(tag_id, word)"


@register("t9_votes_long_list", rf"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(text, '[\p{{L}}\p{{M}}\p{{N}}_]+')) AS word FROM documents),
    l AS (SELECT tag_id, word, count(*) AS weight FROM (SELECT * FROM {_SQL_LONG}) GROUP BY tag_id, word)
    SELECT doc_id, CAST(tag_id AS INT) AS tag_id, CAST(sum(weight) AS BIGINT) AS votes FROM w JOIN l ON w.word = l.word GROUP BY doc_id, tag_id""")
def _(spark, sf):
    votes = category_votes(texts(spark, sf, "documents", "doc_id", "text"), _tags(spark, LONG_TAGS), F.col("text"), "doc_id")
    return votes.where(F.col("tag_id").isNotNull())


@register("t10_cms", """SELECT c_custkey AS domain_id, CASE WHEN c_custkey % 7 = 3 THEN 'Bitrix'
    WHEN c_custkey % 5 = 2 THEN 'Wordpress' ELSE '' END AS cms FROM customer""")
def _(spark, sf):
    return planted(spark, sf, "page_fetch").select("domain_id", fn.cms(F.col("html")).alias("cms"))


@register("t11_flags", "SELECT page_id, contains(url, 'www.') AS is_www, contains(url, 'https://') AS is_https_redirect FROM pages")
def _(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select("page_id", fn.is_www(url).alias("is_www"), fn.is_https(url).alias("is_https_redirect"))


@register("t12_joined_lists", f"""WITH i AS (SELECT c_custkey AS domain_id, list_sort({SQL_PLANTED_INNS}) AS l FROM customer)
    SELECT domain_id, array_to_string(l, ',') AS inn, coalesce((SELECT string_agg(trim(n_name), ',' ORDER BY trim(n_name))
    FROM (SELECT unnest(l) AS x) JOIN nation ON CAST(substr(x, 1, 2) AS INT) = n_nationkey + 40), '') AS city FROM i""")
def _(spark, sf):
    regions = table(spark, sf, "nation").select((F.col("n_nationkey") + 40).alias("id"), F.concat(F.lit(" "), "n_name").alias("region"))
    pages = extract_features(planted(spark, sf, "page_fetch"))
    city = fn.sorted_csv(region_names(F.col("inns"), regions))
    return pages.select("domain_id", fn.sorted_csv(F.col("inns")).alias("inn"), city.alias("city"))


@register("t13_company_names", """SELECT c_custkey AS domain_id, 'ООО ' || c_mktsegment || '|' || 'ЗАО  Лес' || (c_custkey % 3) AS names FROM customer""")
def _(spark, sf):
    text = F.concat(F.lit("От ООО "), "c_mktsegment", F.lit(", ЗАО  Лес"), (F.col("c_custkey") % 3).cast("string"), F.lit(" и ОООО нет"))
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("domain_id"), F.array_join(fn.company_names(text), "|").alias("names"))


@register("t14_bare_host", "SELECT page_id, trim(split_part(url, ':', 2), '/') AS host FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", fn.bare_host(F.col("url")).alias("host"))


@register("t_extract_pages", f"""SELECT page_id, {sql_clean(sql_decode(f"regexp_extract({sql_markup('html')}, '(?is)<title[^>]*>(.*?)</title', 1)"))} AS title,
    '' AS description, '' AS keywords, CAST(length({sql_text('html')}) AS INT) AS text_length,
    {sql_emails(sql_text('html'))} AS emails, {sql_phones(sql_text('html'))} AS phones, '' AS cms, contains(url, 'www.') AS is_www FROM pages""")
def _(spark, sf):
    """All features of the page table in one pass."""
    return extract_features(texts(spark, sf, "pages", "page_id", "url", "html"), url_col="url").select(
        "page_id", "title", "description", "keywords", F.length("text").alias("text_length"),
        fn.sorted_csv(F.col("emails")).alias("emails"), fn.sorted_csv(F.col("phones")).alias("phones"), "cms", "is_www",
    )
