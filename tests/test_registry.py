"""Registry documents."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from siteledger.operators import parse_registry, turnover_segment
from siteledger.plans import load_registry
from siteledger.schemas import REGISTRY_DOCS, TABLES

A = "@attributes"
DOC = {
    "СвЮЛ": {
        A: {"ПолнНаимОПФ": "ООО"},
        "СвНаимЮЛ": {A: {"НаимЮЛПолн": "X", "НаимЮЛСокр": "X"}},
        "СвАдресЮЛ": {"АдресРФ": {A: {"Индекс": "101000", "Дом": "1"}, "Регион": {A: {"НаимРегион": "R"}}}},
        "СведДолжнФЛ": [{"СвФЛ": {A: {"Фамилия": "A"}}}],
        "СвУстКап": {A: {"СумКап": "300"}},
        "СвУчредит": {"УчрФЛ": {"СвФЛ": {A: {"Имя": "B"}}, "ДоляУстКап": {A: {"НоминСтоим": "100"}}}},
    },
    "fin": {
        "msp": {A: {"cat": "1"}},
        "y2019": {A: {"income": "1500000", "outcome": "900000"}},
        "y2020": {A: {"income": "2000000", "outcome": "1000000", "n": "5"}},
    },
}
FULL = {
    "СвЮЛ": {
        A: {"ПолнНаимОПФ": "АО"},
        "СвНаимЮЛ": {A: {"НаимЮЛПолн": "АО \\\"Ро'за\\\" ветров", "НаимЮЛСокр": ""}},
        "СвАдресЮЛ": {
            "АдресРФ": {
                A: {"Индекс": "620000", "Дом": "д. 5", "Корпус": "", "Кварт": "кв 7"},
                "Регион": {A: {"НаимРегион": "Свердловская"}},
                "Город": {A: {"НаимГород": "Екатеринбург \"Е\""}},
                "Улица": {A: {"ТипУлица": "улица", "НаимУлица": "Ленина"}},
            }
        },
        "СведДолжнФЛ": {"СвФЛ": {A: {"Фамилия": "И", "Имя": "П", "Отчество": "С"}}, "СвДолжн": {A: {"НаимДолжн": "Директор"}}},
        "СвОбрЮЛ": {A: {"ДатаОГРН": "2010-02-03"}},
        "СвУстКап": {A: {"СумКап": 10000}},
        "СвУчредит": {
            "УчрФЛ": [
                {"СвФЛ": {A: {"Фамилия": "И", "Имя": "П", "ИННФЛ": "1"}}, "ДоляУстКап": {A: {"НоминСтоим": "2900"}}},
                {"СвФЛ": {A: {"Фамилия": "Q"}}},
            ]
        },
        "СвОКВЭД": {
            "СвОКВЭДОсн": {A: {"НаимОКВЭД": "Лес", "КодОКВЭД": "02.1"}},
            "СвОКВЭДДоп": [{A: {"КодОКВЭД": "1", "НаимОКВЭД": "a", "ПрВерсОКВЭД": "2014"}}, {A: {"КодОКВЭД": "2"}}],
        },
    },
    "fin": {
        "y2021": {A: {"income": "7000", "outcome": "0"}},
        "y2018": {A: {"income": "400000000", "outcome": "400000000"}},
        "msp": {A: {"inc_date": "0000-00-00"}},
    },
}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, "11", json.dumps(DOC, ensure_ascii=False)),
        (2, "22", json.dumps(FULL, ensure_ascii=False)),
        (3, "33", "[]"),
        (4, "44", None),
        (5, "55", "{}"),
        (6, "66", "{broken"),
        (7, "77", '{"fin": [], "СвЮЛ": {"СведДолжнФЛ": [], "СвУчредит": {"УчрФЛ": []}}}'),
    ]
    return spark.createDataFrame(rows, REGISTRY_DOCS)


def test_short_document(docs):
    out = parse_registry(docs.where("inn_id = 1"))
    info = out["company_info"].first()
    assert (info["type"], info["name"], info["region"], info["city"]) == ("ООО", "X", "R", "R")
    assert (info["last_finance_year"], info["segment"], info["employees_number"]) == (2020, 2, 5)
    assert info["registration_date"] is None and info["registry_category"] == "1"
    assert info["address"] == "1"
    assert info["boss_name"] == "A  "
    assert info["yandex_reviews"] == "https://yandex.ru/maps/?text=X+R+101000"
    years = [tuple(r)[2:] for r in out["company_finances"].collect()]
    assert years == [(2019, 1.5, 0.9, 0.6), (2020, 2.0, 1.0, 1.0)]
    founders = [tuple(r)[2:] for r in out["company_founders"].collect()]
    assert founders == [("B", "", "100", 33.0)]
    assert out["rejects"].count() == 0


def test_full_document(docs):
    out = parse_registry(docs.where("inn_id = 2"))
    info = out["company_info"].first()
    assert info["name"] == "АО Роза ветров"
    assert info["address"] == "улица Ленина, д. 5, , кв 7"
    assert info["city"] == 'Екатеринбург "Е"'
    assert info["google_reviews"] == "https://www.google.ru/maps?q=АО%20Роза%20ветров+Екатеринбург%20Е+620000"
    assert info["registration_date"] == datetime.date(2010, 2, 3) and info["registry_date"] is None
    assert (info["boss_name"], info["boss_post"], info["main_activity"]) == ("И П С", "Директор", "Лес")
    assert info["authorized_capital_amount"] == "10000"
    # The last year is the last one in the document, not the highest.
    assert (info["last_finance_year"], info["segment"]) == (2018, 10)
    founders = [tuple(r)[2:] for r in out["company_founders"].collect()]
    assert founders == [("И П", "1", "2900", round(2900 / 10000, 2) * 100), ("Q", "", "0", 0.0)]
    codes = [tuple(r)[2:] for r in out["company_additional_activities"].collect()]
    assert codes == [("1", "a", "2014"), ("2", "", "")]


def test_rejects_and_empty_documents(docs):
    out = parse_registry(docs)
    assert sorted(r["inn_id"] for r in out["rejects"].collect()) == [3, 4, 6]
    info = {r["inn_id"]: r for r in out["company_info"].collect()}
    assert sorted(info) == [1, 2, 5, 7]
    assert (info[5]["segment"], info[5]["last_finance_year"], info[5]["name"]) == (None, 0, "")
    assert info[7]["address"] == " "


def test_segments(spark):
    values = [0.0, 0.1, 0.11, 1.0, 3.0, 5.0, 10.0, 20.0, 40.0, 80.0, 160.0, 320.0, 320.01, 9999999.0, 10000000.0]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(turnover_segment(F.col("v")).alias("s"))
    assert [r["s"] for r in df.collect()] == [0, 0, 1, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 10, None]


def test_load_twice_changes_nothing(spark, docs):
    names = ["company_info", "company_finances", "company_founders", "company_additional_activities"]
    tables = {n: spark.createDataFrame([], TABLES[n]) for n in names}
    once = load_registry(tables, docs)
    twice = load_registry(once, docs)
    for name in names:
        assert once[name].schema == TABLES[name]
        assert sorted(map(repr, once[name].collect())) == sorted(map(repr, twice[name].collect()))
    assert once["company_finances"].count() == 4


def test_later_documents_and_entries_win(spark):
    def doc(name, founders, **fin):
        body = {"СвЮЛ": {"СвНаимЮЛ": {A: {"НаимЮЛПолн": name}}, "СвУчредит": {"УчрФЛ": founders}},
                "fin": {y: {A: {"income": v}} for y, v in fin.items()}}
        return json.dumps(body, ensure_ascii=False)

    def founder(name, inn):
        return {"СвФЛ": {A: {"Имя": name, "ИННФЛ": inn}}}

    rows = [
        (1, "11", doc("new", [founder("B", "2")], y2021="3000000"), 2),
        (1, "11", doc("old", [founder("B", "9"), founder("C", "8"), founder("C", "5")], y2020="1000000", y2021="2000000", yfoo="1"), 1),
    ]
    names = ["company_info", "company_finances", "company_founders", "company_additional_activities"]
    tables = {n: spark.createDataFrame([], TABLES[n]) for n in names}
    out = load_registry(tables, spark.createDataFrame(rows, "inn_id long, inn string, doc string, seq long"))
    assert [r["name"] for r in out["company_info"].collect()] == ["new"]
    assert sorted((r["year"], r["income"]) for r in out["company_finances"].collect()) == [(2020, 1.0), (2021, 3.0)]
    assert sorted((r["founder_full_name"], r["founder_inn"]) for r in out["company_founders"].collect()) == [("B", "2"), ("C", "5")]
