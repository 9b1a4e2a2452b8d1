"""Company registry documents (JSON) to company tables.

A document is parsed once with an explicit schema. Fields that hold either a
list or one object are declared as text and parsed again as an array: a single
root object is then read as an array of one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import python_round2
from ..functions.strings import python_strip

# Upper bounds (inclusive) of turnover in millions, segments 0 to 10.
SEGMENT_BOUNDS = [0.1, 1, 3, 5, 10, 20, 40, 80, 160, 320, 9999999]
# Fixed value: year whose record holds the number of employees.
EMPLOYEES_YEAR = "y2020"

ATTRS = "@attributes"


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def _attrs(*names: str) -> T.StructType:
    return T.StructType([T.StructField(ATTRS, T.StructType([T.StructField(n, T.StringType()) for n in names]))])


def _with_attrs(names: tuple[str, ...], **more) -> T.StructType:
    return T.StructType([*_attrs(*names).fields, *_struct(**more).fields])


_TEXT = T.StringType()
DOC_SCHEMA = _struct(
    СвЮЛ=_with_attrs(
        ("ПолнНаимОПФ",),
        СвНаимЮЛ=_attrs("НаимЮЛПолн", "НаимЮЛСокр"),
        СвАдресЮЛ=_struct(
            АдресРФ=_with_attrs(
                ("Индекс", "КодРегион", "Дом", "Корпус", "Кварт"),
                Регион=_attrs("НаимРегион", "ТипРегион"),
                Город=_attrs("НаимГород", "ТипГород"),
                Улица=_attrs("НаимУлица", "ТипУлица"),
            )
        ),
        СведДолжнФЛ=_TEXT,
        СвОбрЮЛ=_attrs("ДатаОГРН"),
        СвУстКап=_attrs("СумКап", "НаимВидКап"),
        СвУчредит=_struct(УчрФЛ=_TEXT),
        СвОКВЭД=_struct(СвОКВЭДОсн=_attrs("НаимОКВЭД", "КодОКВЭД", "ПрВерсОКВЭД"), СвОКВЭДДоп=_TEXT),
    ),
    fin=_TEXT,
    _bad=_TEXT,
)
_PERSON = _attrs("Фамилия", "Имя", "Отчество", "ИННФЛ")
_OFFICIALS = T.ArrayType(_struct(СвФЛ=_PERSON, СвДолжн=_attrs("ВидДолжн", "НаимВидДолжн", "НаимДолжн")))
_FOUNDERS = T.ArrayType(_struct(СвФЛ=_PERSON, ДоляУстКап=_attrs("НоминСтоим")))
_ACTIVITIES = T.ArrayType(_attrs("КодОКВЭД", "НаимОКВЭД", "ПрВерсОКВЭД"))
_FINANCES = T.MapType(T.StringType(), _attrs("income", "outcome", "n", "cat", "inc_date"))


def _get(root: Column, *path: str, default: str | None = "") -> Column:
    value = root
    for name in path:
        value = value.getField(name)
    return value if default is None else F.coalesce(value, F.lit(default))


def _person(root: Column) -> list[Column]:
    return [_get(root, "СвФЛ", ATTRS, n) for n in ("Фамилия", "Имя", "Отчество")]


def _amount(col: Column) -> Column:
    return F.coalesce(col.try_cast("double"), F.lit(0.0))


def clean_name(col: Column) -> Column:
    """Remove backslash-quote pairs and single quotes."""
    return F.replace(F.replace(col, F.lit('\\"'), F.lit("")), F.lit("'"), F.lit(""))


def full_address(street_type: Column, street: Column, house: Column, block: Column, flat: Column) -> Column:
    """"type name, house, block, flat" without loose commas; the street alone when there is no house."""
    road = F.concat_ws(" ", street_type, street)
    whole = F.trim(F.concat_ws(", ", road, house, block, flat), F.lit(" ,"))
    return F.when(house != F.lit(""), whole).otherwise(road)


def map_query(name: Column, place: Column, index: Column) -> Column:
    """Search text for the map sites: parts joined by +, blanks as %20, no quotes."""
    joined = F.concat_ws("+", name, place, index)
    return F.translate(F.replace(joined, F.lit(" "), F.lit("%20")), "\"'", "")


def founder_percent(part: Column, capital: Column) -> Column:
    """Share in percent from a two-digit ratio; 0 unless both amounts are positive."""
    both = (part > 0) & (capital > 0)
    return F.when(both, python_round2(F.try_divide(part, capital)) * 100.0).otherwise(F.lit(0.0))


def turnover_segment(turnover: Column) -> Column:
    """Segment 0 to 10 by turnover in millions; NULL above the last bound."""
    segment = F.when(turnover <= F.lit(SEGMENT_BOUNDS[0]), F.lit(0))
    for i, bound in enumerate(SEGMENT_BOUNDS[1:], start=1):
        segment = segment.when(turnover <= F.lit(bound), F.lit(i))
    return segment


def date_or_null(col: Column) -> Column:
    """ISO date; the zero date and anything else become NULL."""
    return F.try_to_date(col, "yyyy-MM-dd")


def _finances(fin: Column) -> Column:
    """Yearly records in document order, in millions."""

    def year(entry: Column) -> Column:
        attrs = entry["value"].getField(ATTRS)
        income = F.coalesce(attrs["income"], F.lit("0")).try_cast("bigint")
        outcome = F.coalesce(attrs["outcome"], F.lit("0")).try_cast("bigint")
        return F.struct(
            F.substr(entry["key"], F.lit(2)).alias("year"),
            python_round2(income / F.lit(1000000.0)).alias("income"),
            python_round2(outcome / F.lit(1000000.0)).alias("outcome"),
            python_round2((income - outcome) / F.lit(1000000.0)).alias("profit"),
        )

    return F.transform(F.filter(F.map_entries(fin), lambda e: e["key"].startswith("y")), year)


def _founders(founders: Column, capital: Column) -> Column:
    def founder(f: Column) -> Column:
        amount = _get(f, "ДоляУстКап", ATTRS, "НоминСтоим", default="0")
        return F.struct(
            python_strip(F.concat_ws(" ", *_person(f))).alias("founder_full_name"),
            _get(f, "СвФЛ", ATTRS, "ИННФЛ").alias("founder_inn"),
            amount.alias("founder_capital_part_amount"),
            founder_percent(_amount(amount), capital).alias("founder_capital_part_percent"),
        )

    return F.transform(F.coalesce(founders, F.array().cast(_FOUNDERS)), founder)


def _activities(activities: Column) -> Column:
    def activity(a: Column) -> Column:
        return F.struct(
            _get(a, ATTRS, "КодОКВЭД").alias("activity_code"),
            _get(a, ATTRS, "НаимОКВЭД").alias("activity_name"),
            _get(a, ATTRS, "ПрВерсОКВЭД").alias("activity_version"),
        )

    return F.transform(F.coalesce(activities, F.array().cast(_ACTIVITIES)), activity)


def read_documents(docs: DataFrame) -> DataFrame:
    """(inn_id, inn, doc) to one flat row per document, its lists as arrays.

    ``is_rejected`` marks missing documents and those that are no JSON object.
    A ``seq`` column, if there is one, is kept.
    """
    given = ["inn_id", "inn", "doc", *[c for c in docs.columns if c == "seq"]]
    parsed = docs.select(
        *given,
        # Exploding a one-element array keeps the row as it is, but filters on
        # the parsed document stay above it and do not parse it again.
        F.explode(F.array(F.from_json("doc", DOC_SCHEMA, {"columnNameOfCorruptRecord": "_bad"}))).alias("_j"),
    )
    org = F.col("_j").getField("СвЮЛ")
    parts = parsed.select(
        *given,
        (
            F.col("doc").isNull() | F.col("_j").isNull() | F.col("_j").getField("_bad").isNotNull()
            | ~F.ltrim("doc").startswith("{")
        ).alias("is_rejected"),
        org.alias("_org"),
        org.getField("СвАдресЮЛ").getField("АдресРФ").alias("_addr"),
        F.get(F.from_json(org.getField("СведДолжнФЛ"), _OFFICIALS), F.lit(0)).alias("_boss"),
        F.from_json(org.getField("СвУчредит").getField("УчрФЛ"), _FOUNDERS).alias("_founders"),
        F.from_json(org.getField("СвОКВЭД").getField("СвОКВЭДДоп"), _ACTIVITIES).alias("_activities"),
        F.from_json(F.col("_j").getField("fin"), _FINANCES).alias("_fin"),
    )
    o, addr, boss, fin = F.col("_org"), F.col("_addr"), F.col("_boss"), F.col("_fin")
    capital = _get(o, "СвУстКап", ATTRS, "СумКап", default="0")
    msp = F.try_element_at(fin, F.lit("msp")).getField(ATTRS)
    staff = F.try_element_at(fin, F.lit(EMPLOYEES_YEAR)).getField(ATTRS)["n"]
    flat = parts.select(
        *given, "is_rejected",
        clean_name(_get(o, "СвНаимЮЛ", ATTRS, "НаимЮЛПолн")).alias("name"),
        clean_name(_get(o, "СвНаимЮЛ", ATTRS, "НаимЮЛСокр")).alias("short_name"),
        _get(o, ATTRS, "ПолнНаимОПФ").alias("type"),
        _get(addr, "Регион", ATTRS, "НаимРегион").alias("region"),
        _get(addr, "Город", ATTRS, "НаимГород").alias("town"),
        full_address(
            _get(addr, "Улица", ATTRS, "ТипУлица"), _get(addr, "Улица", ATTRS, "НаимУлица"),
            _get(addr, ATTRS, "Дом"), _get(addr, ATTRS, "Корпус"), _get(addr, ATTRS, "Кварт"),
        ).alias("address"),
        _get(addr, ATTRS, "Индекс").alias("post_index"),
        date_or_null(_get(o, "СвОбрЮЛ", ATTRS, "ДатаОГРН", default=None)).alias("registration_date"),
        F.concat_ws(" ", *_person(boss)).alias("boss_name"),
        _get(boss, "СвДолжн", ATTRS, "НаимДолжн").alias("boss_post"),
        capital.alias("authorized_capital_amount"),
        date_or_null(msp["inc_date"]).alias("registry_date"),
        F.coalesce(msp["cat"], F.lit("")).alias("registry_category"),
        F.coalesce(staff, F.lit("0")).try_cast("int").alias("employees_number"),
        _get(o, "СвОКВЭД", "СвОКВЭДОсн", ATTRS, "НаимОКВЭД").alias("main_activity"),
        F.coalesce(_finances(fin), F.array().cast(_YEARS)).alias("finances"),
        _founders(F.col("_founders"), _amount(capital)).alias("founders"),
        _activities(F.col("_activities")).alias("activities"),
    )
    last = F.try_element_at("finances", F.lit(-1))
    place = F.when(F.col("town") != "", F.col("town")).otherwise(F.col("region"))
    label = F.when(F.col("short_name") != "", F.col("short_name")).otherwise(F.col("name"))
    return flat.select(
        "*",
        F.when(python_strip(F.col("town")) != "", F.col("town")).otherwise(F.col("region")).alias("city"),
        map_query(label, place, F.col("post_index")).alias("_query"),
        turnover_segment(last["income"] + last["outcome"]).alias("segment"),
        F.coalesce(last["year"], F.lit("0")).try_cast("int").alias("last_finance_year"),
    ).withColumns(
        {
            # Addresses of the two map searches.
            "yandex_reviews": F.concat(F.lit("https://yandex.ru/maps/?text="), F.col("_query")),
            "google_reviews": F.concat(F.lit("https://www.google.ru/maps?q="), F.col("_query")),
        }
    ).drop("_query", "town")


_YEARS = "array<struct<year string, income double, outcome double, profit double>>"

COMPANY_INFO_COLUMNS = [
    "inn_id", "inn", "name", "type", "segment", "region", "city", "address", "post_index",
    "registration_date", "boss_name", "boss_post", "yandex_reviews", "google_reviews",
    "authorized_capital_amount", "registry_date", "registry_category", "employees_number",
    "main_activity", "last_finance_year",
]


def registry_tables(read: DataFrame, order: bool = False) -> dict[str, DataFrame]:
    """The company tables and the rejects out of ``read_documents``.

    With ``order`` the rows carry ``seq``: the one of their document, then
    their place in it.
    """
    good = read.where(~F.col("is_rejected"))
    seq = F.col("seq") if "seq" in read.columns else F.lit(0)

    def child(array: str) -> DataFrame:
        rows = good.select("inn_id", "inn", seq.alias("_seq"), F.posexplode(array).alias("_pos", "_e"))
        return rows.select("inn_id", "inn", "_e.*", *([F.struct("_seq", "_pos").alias("seq")] if order else []))

    # Keys that start like a year but hold no number name no year.
    finances = child("finances").withColumn("year", F.col("year").try_cast("int")).where(F.col("year").isNotNull())
    return {
        "company_info": good.select(*COMPANY_INFO_COLUMNS, *([seq.alias("seq")] if order else [])),
        "company_finances": finances,
        "company_founders": child("founders"),
        "company_additional_activities": child("activities"),
        "rejects": read.where("is_rejected").select("inn_id", "inn", "doc"),
    }


def parse_registry(docs: DataFrame) -> dict[str, DataFrame]:
    """Company tables of a document table; see ``plans.registry`` for the staged job."""
    return registry_tables(read_documents(docs))
