"""Inputs the test tables lack, derived row by row from them.

Each input is a list of (column, expression) pairs over one table. The same
expressions run in Spark and, as a WITH query, in the checking engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import table

K = "CAST(c_custkey AS STRING)"
INN10 = "lpad(CAST(c_custkey * 7919 + 1000000007 AS STRING), 10, '0')"
INN12 = "lpad(CAST(c_custkey * 104729 + 500100000000 AS STRING), 12, '0')"
PHONE4 = "lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')"

TITLE = (
    "CASE WHEN c_custkey % 11 = 3 THEN '404 Not Found' WHEN c_custkey % 13 = 5 THEN 'Купить домен тут' "
    "WHEN c_custkey % 17 = 6 THEN 'Поддомены и loadings' ELSE c_name || ' &amp; &quot;Co&quot;' END"
)
HTML = (
    "'<html><head><title> ' || " + TITLE + " || ' </title>"
    "<script>var t = \"<title>no</title> x' || " + K + " || '@no.com\";</script>"
    "<meta content=\"' || c_mktsegment || ' &gt; all\" name=\"description\">' || "
    "CASE WHEN c_custkey % 4 = 1 THEN '<meta name=\"keywords\" content=\"' || repeat(c_mktsegment || ', ', 150) || '\">' ELSE '' END || "
    "'</head><body>' || "
    "CASE WHEN c_custkey % 2 = 1 THEN '<a href=\"mailto:u' || " + K + " || '@ex' || CAST(c_custkey % 7 AS STRING) || '.com?subject=hi\">m</a>' ELSE '' END || "
    "CASE WHEN c_custkey % 6 = 0 THEN ' <p>Write to Info' || " + K + " || '@Firm.co.uk. </p> ' ELSE '' END || "
    "CASE WHEN c_custkey % 3 = 1 THEN '<a href=\"tel:+7 (495) 123-' || " + PHONE4 + " || '\"></a>' ELSE '' END || "
    "CASE WHEN c_custkey % 5 = 2 THEN '<link href=\"/wp-content/themes/x.css\">' ELSE '' END || "
    "CASE WHEN c_custkey % 7 = 3 THEN '<img src=\"/bitrix/x.png\">' ELSE '' END || "
    "CASE WHEN c_custkey % 4 = 0 THEN ' ' || " + INN10 + " || ' ' ELSE '' END || "
    "CASE WHEN c_custkey % 6 = 2 THEN ' ' || " + INN12 + " || ' ' ELSE '' END || "
    "CASE WHEN c_custkey % 19 = 4 THEN '<p>Account has been suspended</p>' ELSE '' END || "
    "'</body></html>'"
)
URL = (
    "CASE WHEN c_custkey % 2 = 0 THEN 'https://' ELSE 'http://' END || CASE WHEN c_custkey % 3 = 0 THEN 'www.' ELSE '' END || "
    "CASE WHEN c_custkey % 23 = 7 THEN 'porno' ELSE 's' END || CAST(c_custkey % 1000 AS STRING) || '.example.com/'"
)

INPUTS: dict[str, tuple[str, list[tuple[str, str]]]] = {
    # One fetch attempt per customer: a page, an HTTP error or a network error.
    "page_fetch": ("customer", [
        ("domain_id", "c_custkey"),
        ("domain", "'s' || " + K + " || '.example.com'"),
        ("zone", "'example.com'"),
        ("previous_status", "CAST(NULL AS INT)"),
        ("http_status", "CAST(CASE WHEN c_custkey % 10 = 9 THEN 503 WHEN c_custkey % 20 = 8 THEN NULL ELSE 200 END AS INT)"),
        ("real_url", URL),
        ("https_real_url", "CASE WHEN c_custkey % 5 = 0 THEN 'https://s.example.com/' WHEN c_custkey % 5 = 1 THEN 'http://s.example.com/' END"),
        ("error_kind", "CASE WHEN c_custkey % 40 = 8 THEN 'timeout' WHEN c_custkey % 40 = 28 THEN 'ssl' END"),
        ("html", HTML),
        ("ip", "'10.0.0.' || CAST(c_custkey % 250 AS STRING)"),
        ("hosting", "CAST(NULL AS STRING)"),
        ("country", "CAST(NULL AS STRING)"),
        ("seq", "c_custkey"),
    ]),
    # Contact pages of the customers, one per order.
    "contact_pages": ("orders", [
        ("domain_id", "o_custkey"),
        ("section", "'contacts'"),
        ("status", "CAST(CASE WHEN o_orderstatus = 'P' THEN 404 ELSE 200 END AS INT)"),
        ("failed", "o_orderkey % 53 = 9"),
        ("html", "'<p> c' || CAST(o_orderkey % 50 AS STRING) || '@shop.ru </p><a href=\"tel:8800' || lpad(CAST(o_orderkey % 90 AS STRING), 7, '0') || '\"></a>'"),
    ]),
    "probes": ("orders", [
        ("domain_id", "o_custkey"),
        ("probe_group", "CASE WHEN o_orderkey % 2 = 0 THEN 'cart' ELSE 'catalog' END"),
        ("section", "'shop'"),
        ("status", "CAST(CASE WHEN o_orderkey % 5 = 0 THEN 200 ELSE 404 END AS INT)"),
        ("failed", "o_orderkey % 31 = 4"),
    ]),
    # Fetch attempts of the customers, one per order.
    "attempts": ("orders", [
        ("domain_id", "o_custkey"),
        ("seq", "o_orderkey"),
        ("http_status", "CAST(CASE WHEN o_orderkey % 7 IN (1, 4) THEN NULL WHEN o_orderkey % 7 = 2 THEN 503 WHEN o_orderkey % 7 = 5 THEN 0 ELSE 200 END AS INT)"),
        ("page_status", "CAST(CASE WHEN o_orderkey % 7 IN (0, 3, 6) THEN CASE WHEN o_orderstatus = 'F' THEN 1000 WHEN o_orderstatus = 'P' THEN 228 ELSE 200 END END AS INT)"),
        ("error_kind", "CASE WHEN o_orderkey % 7 = 1 THEN CASE WHEN o_orderkey % 3 = 0 THEN 'timeout' WHEN o_orderkey % 3 = 1 THEN 'disconnect' ELSE 'connect' END WHEN o_orderkey % 7 = 4 THEN 'ssl' END"),
        ("real_url", "'http://r' || CAST(o_orderkey AS STRING) || '.ru/'"),
    ]),
    # Domains with a status of an earlier crawl.
    "domains": ("customer", [
        ("id", "c_custkey"),
        ("domain", "'s' || " + K + " || '.example.com'"),
        ("zone", "'example.com'"),
        ("real_domain", "CASE WHEN c_custkey % 3 = 0 THEN 'http://old' || " + K + " || '.ru/' ELSE '' END"),
        ("status", "CAST(CASE WHEN c_custkey % 3 = 0 THEN 200 WHEN c_custkey % 3 = 1 THEN 404 ELSE 0 END AS INT)"),
    ]),
    # Fetched pages as stored sites, with a status per order priority.
    "order_domains": ("orders", [
        ("id", "o_orderkey"),
        ("domain", "'d' || CAST(o_orderkey AS STRING) || '.ru'"),
        ("real_domain", "CASE WHEN o_orderkey % 3 > 0 THEN 'http://d' || CAST(o_custkey AS STRING) || '.ru/' END"),
        ("status", "CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 404 WHEN '2-HIGH' THEN 408 WHEN '3-MEDIUM' THEN 228 WHEN '4-NOT SPECIFIED' THEN 200 END AS INT)"),
        ("cms", "CASE o_orderpriority WHEN '1-URGENT' THEN 'Bitrix' WHEN '2-HIGH' THEN 'Wordpress' WHEN '3-MEDIUM' THEN '' END"),
    ]),
    "site_info": ("customer", [
        ("id", "c_custkey"),
        ("domain_id", "c_custkey + 7"),
        ("real_domain", URL),
        ("title", "CASE WHEN c_custkey % 29 = 2 THEN NULL ELSE " + TITLE + " END"),
        ("description", "CASE WHEN c_custkey % 31 = 3 THEN 'Ставки на спорт' ELSE repeat(c_mktsegment || ' ', 20) END"),
    ]),
    "phones": ("customer", [
        ("domain_id", "c_custkey"),
        ("number", "CASE WHEN c_custkey % 2 = 0 THEN '7' ELSE '8' END || lpad(CAST(c_custkey * 7919003 % 1000000000 AS STRING), 10, '4')"),
    ]),
    "inn_rows": ("orders", [
        ("inn", "lpad(CAST(o_orderkey AS STRING), 10, '0')"),
        ("domain_id", "CASE WHEN o_orderkey % 3 > 0 THEN o_custkey END"),
    ]),
}

_Q = '"'
_ATTR = '"@attributes"'


def _obj(**fields: str) -> str:
    """SQL text that prints an attribute object; values are SQL strings."""
    inner = " || ', ' || ".join(f"'\"{k}\": \"' || {v} || '\"'" for k, v in fields.items())
    return f"'{{{_ATTR}: {{' || {inner} || '}}}}'"


_FOUNDER = (
    "'{\"СвФЛ\": ' || " + _obj(Фамилия="'Петров' || " + K, Имя="'Иван'", ИННФЛ=INN12)
    + " || ', \"ДоляУстКап\": ' || " + _obj(НоминСтоим="CAST(c_custkey % 40 * 260 AS STRING)") + " || '}'"
)
_OFFICIAL = (
    "'{\"СвФЛ\": ' || " + _obj(Фамилия="'Сидоров'", Имя="'Пётр' || " + K, Отчество="'Ильич'")
    + " || ', \"СвДолжн\": ' || " + _obj(НаимДолжн="'Директор'") + " || '}'"
)
_ACTIVITY = _obj(КодОКВЭД="'0' || CAST(c_custkey % 9 AS STRING) || '.1'", НаимОКВЭД="c_mktsegment", ПрВерсОКВЭД="'2014'")
_ACTIVITY2 = _obj(КодОКВЭД="'62.0'", НаимОКВЭД="'IT'")
_DOC = (
    "'{\"СвЮЛ\": {\"@attributes\": {\"ПолнНаимОПФ\": \"ООО\"}, \"СвНаимЮЛ\": ' || "
    + _obj(НаимЮЛПолн="'ООО ' || chr(92) || chr(92) || chr(92) || chr(34) || c_name || chr(39) || chr(92) || chr(92) || chr(92) || chr(34)", НаимЮЛСокр="CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'К ' || c_name END")
    + " || ', \"СвАдресЮЛ\": {\"АдресРФ\": {\"@attributes\": {\"Индекс\": \"' || lpad(" + K + ", 6, '1') || '\", \"Дом\": \"' || CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'дом ' || " + K + " END || '\", \"Кварт\": \"' || CASE WHEN c_custkey % 5 = 0 THEN '' ELSE '7' END || '\"}, \"Регион\": ' || "
    + _obj(НаимРегион="'Регион ' || CAST(c_nationkey AS STRING)")
    + " || CASE WHEN c_custkey % 2 = 0 THEN ', \"Город\": ' || " + _obj(НаимГород="'Город'") + " ELSE '' END || ', \"Улица\": ' || "
    + _obj(ТипУлица="'улица'", НаимУлица="c_mktsegment")
    + " || '}}, \"СведДолжнФЛ\": ' || CASE WHEN c_custkey % 2 = 0 THEN '[' || " + _OFFICIAL + " || ', {}]' ELSE " + _OFFICIAL + " END"
    + " || ', \"СвОбрЮЛ\": ' || " + _obj(ДатаОГРН="CASE WHEN c_custkey % 6 = 0 THEN '0000-00-00' ELSE '2011-02-' || lpad(CAST(c_custkey % 28 + 1 AS STRING), 2, '0') END")
    + " || ', \"СвУстКап\": ' || " + _obj(СумКап="'10000'")
    + " || ', \"СвУчредит\": {\"УчрФЛ\": ' || CASE WHEN c_custkey % 3 = 0 THEN '[' || " + _FOUNDER + " || ', {\"СвФЛ\": {\"@attributes\": {\"Имя\": \"Анна\"}}}]' ELSE " + _FOUNDER + " END"
    + " || '}, \"СвОКВЭД\": {\"СвОКВЭДОсн\": ' || " + _obj(НаимОКВЭД="'Торговля ' || c_mktsegment")
    + " || ', \"СвОКВЭДДоп\": ' || CASE WHEN c_custkey % 2 = 1 THEN '[' || " + _ACTIVITY + " || ', ' || " + _ACTIVITY2 + " || ']' ELSE " + _ACTIVITY + " END"
    + " || '}}, \"fin\": {\"msp\": ' || " + _obj(cat="CAST(c_custkey % 3 + 1 AS STRING)", inc_date="'2016-08-01'")
    + " || ', \"y2020\": ' || " + _obj(income="CAST(c_custkey * 12340 + 1 AS STRING)", outcome="CAST(c_custkey * 2340 + 2 AS STRING)", n="CAST(c_custkey % 100 AS STRING)")
    + " || CASE WHEN c_custkey % 2 = 0 THEN ', \"y2019\": ' || " + _obj(income="CAST(c_custkey * 910000 + 1 AS STRING)", outcome="'50000'") + " ELSE '' END || '}}'"
)
INPUTS["registry_docs"] = ("customer", [
    ("inn_id", "c_custkey"),
    ("inn", INN10),
    ("doc", "CASE WHEN c_custkey % 41 = 7 THEN '[]' WHEN c_custkey % 41 = 8 THEN NULL WHEN c_custkey % 41 = 9 THEN '{broken' ELSE " + _DOC + " END"),
])


def planted(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns = INPUTS[name]
    return table(spark, sf_dir, source).selectExpr(*[f"{expr} AS {column}" for column, expr in columns])


def planted_sql(*names: str) -> str:
    """WITH clause that defines the inputs for the checking engine."""
    parts = []
    for name in names:
        source, columns = INPUTS[name]
        parts.append(f"{name} AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in columns) + f" FROM {source})")
    return "WITH " + ", ".join(parts) + " "
