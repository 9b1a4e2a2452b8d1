"""Registry documents (X)."""

from __future__ import annotations

from pyspark.sql import functions as F

from siteledger.operators import parse_registry, read_documents
from siteledger.plans import load_registry
from siteledger.schemas import TABLES

from . import ORACLE, register
from .planted import planted, planted_sql

SQL_GOOD = planted_sql("registry_docs") + """, good AS MATERIALIZED (SELECT inn_id, inn, doc FROM registry_docs
    WHERE inn_id % 41 NOT IN (7, 8, 9)) """


def _path(*names: str) -> str:
    return "coalesce(doc->>'$" + "".join(f'."{n}"' for n in names) + "', '')"


A = "@attributes"
SQL_TOWN, SQL_REGION = (_path("СвЮЛ", "СвАдресЮЛ", "АдресРФ", *p) for p in (("Город", A, "НаимГород"), ("Регион", A, "НаимРегион")))
SQL_CITY = f"CASE WHEN {SQL_TOWN} <> '' THEN {SQL_TOWN} ELSE {SQL_REGION} END"
SQL_FULL = f"replace(replace({_path('СвЮЛ', 'СвНаимЮЛ', A, 'НаимЮЛПолн')}, chr(92) || chr(34), ''), chr(39), '')"
SQL_SHORT = f"replace(replace({_path('СвЮЛ', 'СвНаимЮЛ', A, 'НаимЮЛСокр')}, chr(92) || chr(34), ''), chr(39), '')"


def info(spark, sf):
    return parse_registry(planted(spark, sf, "registry_docs"))["company_info"]


@register("x1_company_fields", SQL_GOOD + f"""SELECT inn_id, inn, {_path('СвЮЛ', A, 'ПолнНаимОПФ')} AS type, {SQL_REGION} AS region,
    {_path('СвЮЛ', 'СвАдресЮЛ', 'АдресРФ', A, 'Индекс')} AS post_index, {_path('СвЮЛ', 'СвУстКап', A, 'СумКап')} AS authorized_capital_amount,
    {_path('fin', 'msp', A, 'cat')} AS registry_category, DATE '2016-08-01' AS registry_date, CAST(inn_id % 100 AS INT) AS employees_number,
    TRY_CAST(NULLIF({_path('СвЮЛ', 'СвОбрЮЛ', A, 'ДатаОГРН')}, '0000-00-00') AS DATE) AS registration_date,
    {_path('СвЮЛ', 'СвОКВЭД', 'СвОКВЭДОсн', A, 'НаимОКВЭД')} AS main_activity FROM good""")
def _(spark, sf):
    return info(spark, sf).select(
        "inn_id", "inn", "type", "region", "post_index", "authorized_capital_amount", "registry_category", "registry_date",
        "employees_number", "registration_date", "main_activity",
    )


@register("x2_list_or_object", SQL_GOOD + "SELECT inn_id, 'Сидоров Пётр' || inn_id || ' Ильич' AS boss_name, 'Директор' AS boss_post FROM good")
def _(spark, sf):
    return info(spark, sf).select("inn_id", "boss_name", "boss_post")


SQL_YEARS = SQL_GOOD + """, y AS (SELECT inn_id, inn, key AS k, ord, CAST(doc->>('$.fin."' || key || '"."@attributes".income') AS BIGINT) AS i,
    CAST(doc->>('$.fin."' || key || '"."@attributes".outcome') AS BIGINT) AS o
    FROM (SELECT inn_id, inn, doc, unnest(json_keys(doc, '$.fin')) AS key, generate_subscripts(json_keys(doc, '$.fin'), 1) AS ord FROM good) WHERE key LIKE 'y%'),
    m AS (SELECT inn_id, inn, CAST(substr(k, 2) AS INT) AS year, ord, round(i / 1000000.0, 2) AS income, round(o / 1000000.0, 2) AS outcome,
    round((i - o) / 1000000.0, 2) AS profit FROM y) """


@register("x3_finances", SQL_YEARS + "SELECT inn_id, inn, year, CAST(income AS DOUBLE) AS income, CAST(outcome AS DOUBLE) AS outcome, CAST(profit AS DOUBLE) AS profit FROM m")
def _(spark, sf):
    return parse_registry(planted(spark, sf, "registry_docs"))["company_finances"]


@register("x4_last_finance_year", SQL_YEARS + "SELECT inn_id, arg_max(year, ord) AS last_finance_year FROM m GROUP BY inn_id")
def _(spark, sf):
    return info(spark, sf).select("inn_id", "last_finance_year")


@register("x5_segment", SQL_YEARS + """SELECT inn_id, CAST(CASE WHEN t <= 0.1 THEN 0 WHEN t <= 1 THEN 1 WHEN t <= 3 THEN 2 WHEN t <= 5 THEN 3 WHEN t <= 10 THEN 4 WHEN t <= 20 THEN 5
    WHEN t <= 40 THEN 6 WHEN t <= 80 THEN 7 WHEN t <= 160 THEN 8 WHEN t <= 320 THEN 9 WHEN t <= 9999999 THEN 10 END AS INT) AS segment
    FROM (SELECT inn_id, arg_max(income + outcome, ord) AS t FROM m GROUP BY inn_id)""")
def _(spark, sf):
    return info(spark, sf).select("inn_id", "segment")


@register("x6_founders", SQL_GOOD + """SELECT inn_id, inn, 'Петров' || inn_id || ' Иван' AS founder_full_name, lpad(CAST(inn_id * 104729 + 500100000000 AS STRING), 12, '0') AS founder_inn,
    CAST(inn_id % 40 * 260 AS STRING) AS founder_capital_part_amount, CAST(round(CAST(round(inn_id % 40 * 260 / 10000.0, 2) * 100 AS DOUBLE), 6) AS DOUBLE) AS founder_capital_part_percent FROM good
    UNION ALL SELECT inn_id, inn, 'Анна', '', '0', 0.0 FROM good WHERE inn_id % 3 = 0""")
def _(spark, sf):
    founders = parse_registry(planted(spark, sf, "registry_docs"))["company_founders"]
    # Two-digit ratio times 100: rounded here only to compare printed digits.
    return founders.withColumn("founder_capital_part_percent", F.round("founder_capital_part_percent", 6))


@register("x7_activities", SQL_GOOD + """SELECT inn_id, inn, '0' || (inn_id % 9) || '.1' AS activity_code, c_mktsegment AS activity_name, '2014' AS activity_version
    FROM good JOIN customer ON c_custkey = inn_id UNION ALL SELECT inn_id, inn, '62.0', 'IT', '' FROM good WHERE inn_id % 2 = 1""")
def _(spark, sf):
    return parse_registry(planted(spark, sf, "registry_docs"))["company_additional_activities"]


@register("x8_address", SQL_GOOD + f"""SELECT inn_id, 'улица ' || c_mktsegment || CASE WHEN inn_id % 4 = 0 THEN '' ELSE ', дом ' || inn_id ||
    CASE WHEN inn_id % 5 = 0 THEN '' ELSE ', , 7' END END AS address, {SQL_CITY} AS city FROM good JOIN customer ON c_custkey = inn_id""")
def _(spark, sf):
    return info(spark, sf).select("inn_id", "address", "city")


@register("x9_map_urls", SQL_GOOD + f""", q AS (SELECT inn_id, replace((CASE WHEN {SQL_SHORT} <> '' THEN {SQL_SHORT} ELSE {SQL_FULL} END) || '+' || {SQL_CITY} || '+' || lpad(CAST(inn_id AS STRING), 6, '1'), ' ', '%20') AS q FROM good)
    SELECT inn_id, 'https://yandex.ru/maps/?text=' || q AS yandex_reviews, 'https://www.google.ru/maps?q=' || q AS google_reviews FROM q""")
def _(spark, sf):
    return info(spark, sf).select("inn_id", "yandex_reviews", "google_reviews")


@register("x10_clean_names", SQL_GOOD + f"SELECT inn_id, {SQL_FULL} AS name, {SQL_SHORT} AS short_name FROM good")
def _(spark, sf):
    return read_documents(planted(spark, sf, "registry_docs")).where(~F.col("is_rejected")).select("inn_id", "name", "short_name")


@register("x_rejects", planted_sql("registry_docs") + "SELECT inn_id, inn, doc FROM registry_docs WHERE inn_id % 41 IN (7, 8, 9)")
def _(spark, sf):
    return parse_registry(planted(spark, sf, "registry_docs"))["rejects"]


def _registry(spark, sf):
    names = ["company_info", "company_finances", "company_founders", "company_additional_activities"]
    return load_registry({n: spark.createDataFrame([], TABLES[n]) for n in names}, planted(spark, sf, "registry_docs"))


@register("plan_registry_founders", SQL_GOOD + """SELECT inn_id, 'Петров' || inn_id || ' Иван' AS founder_full_name FROM good
    UNION ALL SELECT inn_id, 'Анна' FROM good WHERE inn_id % 3 = 0""")
def _(spark, sf):
    return _registry(spark, sf)["company_founders"].select("inn_id", "founder_full_name")


@register("plan_registry_finances", ORACLE["x3_finances"])
def _(spark, sf):
    return _registry(spark, sf)["company_finances"].select("inn_id", "inn", "year", "income", "outcome", "profit")


@register("plan_registry_activities", ORACLE["x7_activities"])
def _(spark, sf):
    return _registry(spark, sf)["company_additional_activities"].select("inn_id", "inn", "activity_code", "activity_name", "activity_version")


@register("plan_registry_addresses", ORACLE["x8_address"])
def _(spark, sf):
    return _registry(spark, sf)["company_info"].select("inn_id", "address", "city")


@register("plan_registry_rejects", ORACLE["x_rejects"])
def _(spark, sf):
    return _registry(spark, sf)["rejects"].select("inn_id", "inn", "doc")
