"""Keyed writes against plain folds."""

import random

from pyspark.sql import functions as F

from siteledger.operators import (
    assign_ids,
    dedupe_real_domain,
    explode_contacts,
    insert_ignore,
    upsert,
    upsert_domain_info,
    upsert_inns,
)

DOMAINS = "id long, domain string, zone string, real_domain string, status int"


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_upsert_updates_named_columns_only(spark):
    existing = spark.createDataFrame([(1, "a.ru", "ru", "old", 404), (2, "b.ru", "ru", "b", 200)], DOMAINS)
    updates = spark.createDataFrame(
        [(1, "", "", "http://a.ru", 200, 1), (1, "", "", "http://a2.ru", 1000, 2), (3, "c.ru", "ru", "c1", 200, 1), (3, "", "", "c2", 404, 5)],
        DOMAINS + ", seq long",
    )
    once = upsert(existing, updates, ["id"], ["real_domain", "status"], "seq")
    expected = [
        (1, "a.ru", "ru", "http://a2.ru", 1000),
        (2, "b.ru", "ru", "b", 200),
        (3, "c.ru", "ru", "c2", 404),
    ]
    assert rows(once, "*") == expected
    assert once.schema == existing.schema
    assert rows(upsert(once, updates, ["id"], ["real_domain", "status"], "seq"), "*") == expected


def test_insert_ignore_keeps_first(spark):
    existing = spark.createDataFrame([(1, "x", 7)], "id long, inn string, domain_id long")
    new = spark.createDataFrame([("a", 1, 1), ("b", 1, 2), ("c", 7, 0)], "inn string, domain_id long, seq long")
    assert rows(insert_ignore(existing, new, ["domain_id"], "seq"), "inn", "domain_id") == [("a", 1), ("x", 7)]


def test_upsert_inns(spark):
    existing = spark.createDataFrame([(1, "a", None), (2, "b", 5)], "id long, inn string, domain_id long")
    batch = [("a", 9, 1), ("b", None, 2), ("c", None, 3), ("c", 4, 4), ("c", 6, 5), ("c", 0, 6), ("d", 0, 7), ("e", 3, 8), ("e", None, 9)]
    table, rejects = upsert_inns(existing, spark.createDataFrame(batch, "inn string, domain_id long, seq long"), "seq")
    assert rows(table, "inn", "domain_id") == [("a", 9), ("b", 5), ("c", 6), ("d", None), ("e", 3)]
    assert rows(rejects, "inn", "seq") == [("b", 2), ("c", 6), ("e", 9)]


INFO = "id long, domain_id long, real_domain string, title string, bitrix_id long"


def fold_info(existing, batch):
    """Row by row, as a database with two unique keys does it."""
    table = [dict(zip(("id", "domain_id", "real_domain", "title", "bitrix_id"), r)) for r in existing]
    rejects = []
    start_owner = {r["real_domain"]: r["domain_id"] for r in table if r["real_domain"] is not None}
    for domain_id, real, title, seq in sorted(batch, key=lambda b: b[3]):
        mine = next((r for r in table if r["domain_id"] == domain_id), None)
        holder = next((r for r in table if real is not None and r["real_domain"] == real), None)
        if mine is not None:
            held_at_start = real in start_owner and start_owner[real] != domain_id
            if (holder is not None and holder is not mine) or (held_at_start and real is not None):
                rejects.append((domain_id, seq))
                continue
            mine.update(real_domain=real, title=title)
        elif holder is not None:
            holder.update(title=title)
        else:
            table.append(dict(id=None, domain_id=domain_id, real_domain=real, title=title, bitrix_id=None))
    return sorted((tuple(r.values()) for r in table), key=repr), sorted(rejects)


def test_upsert_domain_info_equals_row_by_row(spark):
    rng = random.Random(11)
    for trial in range(6):
        names = [f"r{i}" for i in range(14)]
        owners = rng.sample(names, 7)
        existing = [(i + 1, i + 1, r, f"old{i}", i if i % 2 else None) for i, r in enumerate(owners)]
        existing.append((90, 90, None, "none", None))
        batch = [
            (d, rng.choice([*names, None]) if rng.random() < 0.7 else "hot", f"t{d}", s)
            for s, d in enumerate(rng.sample(range(1, 40), 24))
        ]
        table, rejects = upsert_domain_info(
            spark.createDataFrame(existing, INFO),
            spark.createDataFrame(batch, "domain_id long, real_domain string, title string, seq long"),
            "seq",
        )
        want, want_rejects = fold_info(existing, batch)
        assert rows(table, "*") == want, trial
        assert rows(rejects, "domain_id", "seq") == want_rejects, trial


def test_repeated_fetches_claim_from_the_first(spark):
    rng = random.Random(4)
    for trial in range(4):
        home = {d: rng.choice(["r1", "r2", "r3", f"own{d}"]) for d in range(1, 12)}
        existing = [(1, 1, home[1], "old", 5)]
        batch = [(d, home[d], f"t{s}", s) for s, d in enumerate(rng.choices(range(1, 12), k=40))]
        table, rejects = upsert_domain_info(
            spark.createDataFrame(existing, INFO),
            spark.createDataFrame(batch, "domain_id long, real_domain string, title string, seq long"),
            "seq",
        )
        want, _ = fold_info(existing, batch)
        assert rows(table, "*") == want, trial
        assert rejects.count() == 0


def test_upsert_domain_info_golden(spark):
    empty = spark.createDataFrame([], INFO)
    batch = spark.createDataFrame([(1, "http://a.ru", "one", 1), (2, "http://a.ru", "two", 2)], "domain_id long, real_domain string, title string, seq long")
    table, rejects = upsert_domain_info(empty, batch, "seq")
    assert rows(table, "domain_id", "title") == [(1, "two")]
    assert rejects.count() == 0
    again, _ = upsert_domain_info(table, batch, "seq")
    assert rows(again, "*") == rows(table, "*")


def test_dedupe_real_domain(spark):
    info = spark.createDataFrame(
        [(1, "a"), (2, "a"), (3, "b"), (4, None), (5, None), (6, "a")], "id long, real_domain string"
    )
    assert rows(dedupe_real_domain(info), "id") == [(1,), (3,), (4,), (5,)]
    keep = spark.createDataFrame([("a", 6)], "real_domain string, id long")
    assert rows(dedupe_real_domain(info, keep), "id") == [(3,), (4,), (5,), (6,)]


def test_assign_ids_are_dense_and_ordered(spark):
    df = spark.range(1000).select((F.lit(5000) - F.col("id")).alias("k"), F.lit("hot").alias("v")).repartition(7)
    got = sorted(tuple(r) for r in assign_ids(df, 10, ["k"]).select("id", "k").collect())
    assert [r[0] for r in got] == list(range(11, 1011))
    assert [r[1] for r in got] == sorted(r[1] for r in got)
    hot = assign_ids(df, 0, ["v"]).select("id").collect()
    assert sorted(r[0] for r in hot) == list(range(1, 1001))
    assert assign_ids(df.where("k < 0"), 3, ["k"]).count() == 0


def test_explode_contacts(spark):
    df = spark.createDataFrame(
        [(1, ["7"], ["a@b.ru "], ["1", "2"]), (2, [], [], [])],
        "domain_id long, phones array<string>, emails array<string>, inns array<string>",
    )
    out = explode_contacts(df)
    assert rows(out["domain_phones"], "*") == [(1, "7")]
    assert rows(out["domain_emails"], "*") == [(1, "a@b.ru")]
    assert rows(out["inns"], "*") == [(1, "1"), (1, "2")]
