"""Keyed writes (U, W, O)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from siteledger import sources
from siteledger.operators import (
    assign_ids,
    dedupe_real_domain,
    explode_contacts,
    extract_features,
    first_per_key,
    insert_ignore,
    last_per_key,
    shared_dir,
    upsert,
    upsert_domain_info,
    upsert_inns,
)

from . import register, table
from .planted import planted, planted_sql
from .text import SQL_PLANTED_INNS, SQL_PLANTED_PHONES


@register("w1_last_write", """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_linenumber DESC, l_partkey DESC, l_quantity DESC) AS rn FROM lineitem) WHERE rn = 1""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return last_per_key(rows, ["l_orderkey"], "l_linenumber")


@register("w1_first_write", """SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey
    ORDER BY l_orderkey, l_linenumber, l_partkey) AS rn FROM lineitem) WHERE rn = 1""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey")
    return first_per_key(rows, ["l_suppkey"], "l_orderkey")


@register("o1_union_distinct", """SELECT c_nationkey AS nation, c_mktsegment AS name FROM customer UNION SELECT s_nationkey, s_name FROM supplier""")
def _(spark, sf):
    a = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("name"))
    b = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"))
    return a.unionByName(b).distinct()


SQL_LINE_UPDATES = """WITH u AS (SELECT l_orderkey * 2 AS k, l_linenumber AS seq, l_returnflag AS status, l_extendedprice AS price, l_partkey AS part,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_extendedprice DESC, l_returnflag DESC) AS rn,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice, l_returnflag) AS rf FROM lineitem) """


@register("u1_upsert", SQL_LINE_UPDATES + """SELECT coalesce(o_orderkey, l.k) AS o_orderkey,
    CASE WHEN o_orderkey IS NULL THEN f.part ELSE o_custkey END AS o_custkey,
    coalesce(l.status, o_orderstatus) AS o_orderstatus, coalesce(l.price, o_totalprice) AS o_totalprice, o_orderpriority
    FROM orders FULL JOIN (SELECT * FROM u WHERE rn = 1) l ON o_orderkey = l.k LEFT JOIN (SELECT * FROM u WHERE rf = 1) f ON f.k = l.k""")
def _(spark, sf):
    existing = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    updates = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 2).alias("o_orderkey"), F.col("l_partkey").alias("o_custkey"), F.col("l_returnflag").alias("o_orderstatus"),
        F.col("l_extendedprice").alias("o_totalprice"), F.col("l_linenumber").alias("seq"),
    )
    return upsert(existing, updates, ["o_orderkey"], ["o_orderstatus", "o_totalprice"], "seq")


@register("u1_upsert_buckets", SQL_LINE_UPDATES + """SELECT coalesce(o_orderkey, l.k) AS o_orderkey, o_custkey,
    coalesce(l.status, o_orderstatus) AS o_orderstatus, coalesce(l.price, o_totalprice) AS o_totalprice
    FROM orders FULL JOIN (SELECT * FROM u WHERE rn = 1) l ON o_orderkey = l.k""")
def _(spark, sf):
    """The same upsert into a partitioned table on disk, which reads and replaces touched partitions only."""
    root = f"{shared_dir(spark)}/buckets-{uuid.uuid4().hex}"
    existing = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    updates = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 2).alias("o_orderkey"), F.col("l_returnflag").alias("o_orderstatus"),
        F.col("l_extendedprice").alias("o_totalprice"), F.col("l_partkey").alias("part"), F.col("l_linenumber").alias("seq"),
    )
    # Lines of one order with one number are told apart by the remaining columns, as in the SQL.
    updates = updates.withColumn("seq", F.struct("seq", "part", "o_totalprice", "o_orderstatus")).drop("part")
    orders = sources.PartitionedTable(spark, root, "orders", existing.schema, ("o_orderkey",), 8)
    orders.replace(existing)
    orders.replace(upsert(orders.near(updates), updates, ["o_orderkey"], ["o_orderstatus", "o_totalprice"], "seq"))
    return orders.read()


@register("u2_insert_ignore", """SELECT s_name AS inn, s_suppkey AS domain_id FROM supplier UNION ALL
    SELECT arg_min(lpad(CAST(o_orderkey AS STRING), 10, '0'), o_orderkey), o_custkey FROM orders
    WHERE o_custkey NOT IN (SELECT s_suppkey FROM supplier) GROUP BY o_custkey""")
def _(spark, sf):
    existing = table(spark, sf, "supplier").select(F.col("s_name").alias("inn"), F.col("s_suppkey").alias("domain_id"))
    rows = table(spark, sf, "orders").select(
        F.lpad(F.col("o_orderkey").cast("string"), 10, "0").alias("inn"), F.col("o_custkey").alias("domain_id"), F.col("o_orderkey").alias("seq")
    )
    return insert_ignore(existing, rows, ["domain_id"], "seq")


SQL_INNS = """WITH e AS (SELECT lpad(CAST(s_suppkey AS STRING), 10, '0') AS inn, CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_nationkey AS BIGINT) END AS domain_id FROM supplier),
    r AS (SELECT lpad(CAST(o_custkey AS STRING), 10, '0') AS inn, CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '1-URGENT' THEN 0 ELSE o_orderkey END AS domain_id,
    o_orderkey AS seq FROM orders), """


def _inns(spark, sf):
    existing = table(spark, sf, "supplier").selectExpr("lpad(CAST(s_suppkey AS STRING), 10, '0') AS inn", "CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_nationkey AS BIGINT) END AS domain_id")
    rows = table(spark, sf, "orders").selectExpr(
        "lpad(CAST(o_custkey AS STRING), 10, '0') AS inn",
        "CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '1-URGENT' THEN 0 ELSE o_orderkey END AS domain_id", "o_orderkey AS seq",
    )
    return upsert_inns(existing, rows, "seq")


@register("u3_upsert_inns", SQL_INNS + """w AS (SELECT inn, max(domain_id) FILTER (WHERE domain_id <> 0) AS owner FROM r GROUP BY inn)
    SELECT coalesce(e.inn, w.inn) AS inn, coalesce(owner, domain_id) AS domain_id FROM e FULL JOIN w ON e.inn = w.inn""")
def _(spark, sf):
    return _inns(spark, sf)[0]


@register("u3_inn_rejects", SQL_INNS + """f AS (SELECT inn, min(seq) AS s FROM r GROUP BY inn)
    SELECT r.inn, r.domain_id, r.seq FROM r JOIN f ON r.inn = f.inn WHERE coalesce(r.domain_id, 0) = 0 AND (r.seq > s OR r.inn IN (SELECT inn FROM e))""")
def _(spark, sf):
    return _inns(spark, sf)[1]


SQL_INFO = """WITH e AS (SELECT s_suppkey AS domain_id, 'http://s' || s_suppkey AS real_domain, s_name AS title FROM supplier),
    r AS (SELECT o_custkey + 10000000 AS domain_id, 'http://s' || (o_custkey % 15013) AS real_domain, o_orderpriority || o_orderkey AS title, o_orderkey AS seq FROM orders), """


def _info(spark, sf):
    existing = table(spark, sf, "supplier").selectExpr("s_suppkey AS domain_id", "'http://s' || s_suppkey AS real_domain", "s_name AS title")
    rows = table(spark, sf, "orders").selectExpr(
        "o_custkey + 10000000 AS domain_id", "'http://s' || (o_custkey % 15013) AS real_domain", "o_orderpriority || o_orderkey AS title", "o_orderkey AS seq"
    )
    return upsert_domain_info(existing, rows, "seq")


@register("u4_upsert_domain_info", SQL_INFO + """g AS (SELECT real_domain, arg_min(domain_id, seq) AS domain_id, arg_max(title, seq) AS title FROM r GROUP BY real_domain)
    SELECT coalesce(e.domain_id, g.domain_id) AS domain_id, coalesce(e.real_domain, g.real_domain) AS real_domain, coalesce(g.title, e.title) AS title
    FROM e FULL JOIN g ON e.real_domain = g.real_domain""")
def _(spark, sf):
    return _info(spark, sf)[0]


SQL_MOVES = """WITH e AS (SELECT s_suppkey AS domain_id, 'http://s' || s_suppkey AS real_domain, s_name AS title FROM supplier),
    r AS (SELECT c_custkey AS domain_id, 'http://s' || (c_custkey + CASE WHEN c_custkey % 3 = 0 THEN 0 WHEN c_custkey % 3 = 1 THEN 1 ELSE 5000000 END) AS real_domain,
    c_name AS title, c_custkey AS seq FROM customer) """


@register("u4_move_rejects", SQL_MOVES + """SELECT r.domain_id, r.real_domain, r.seq, r.title FROM r JOIN e ON r.domain_id = e.domain_id JOIN e o ON o.real_domain = r.real_domain
    WHERE r.real_domain <> e.real_domain""")
def _(spark, sf):
    """Known domains that want the address of another one."""
    existing = table(spark, sf, "supplier").selectExpr("s_suppkey AS domain_id", "'http://s' || s_suppkey AS real_domain", "s_name AS title")
    rows = table(spark, sf, "customer").selectExpr(
        "c_custkey AS domain_id", "'http://s' || (c_custkey + CASE WHEN c_custkey % 3 = 0 THEN 0 WHEN c_custkey % 3 = 1 THEN 1 ELSE 5000000 END) AS real_domain",
        "c_name AS title", "c_custkey AS seq",
    )
    return upsert_domain_info(existing, rows, "seq")[1]


@register("u5_dedupe_real_domain", planted_sql("order_domains") + """SELECT id, real_domain FROM (SELECT id, real_domain,
    row_number() OVER (PARTITION BY real_domain ORDER BY id) AS rn FROM order_domains) WHERE rn = 1 OR real_domain IS NULL""")
def _(spark, sf):
    return dedupe_real_domain(planted(spark, sf, "order_domains")).select("id", "real_domain")


@register("u5_dedupe_listed", planted_sql("order_domains") + """, k AS (SELECT real_domain, max(id) AS keep FROM order_domains WHERE real_domain IS NOT NULL AND id % 2 = 1 GROUP BY real_domain)
    SELECT id, o.real_domain FROM order_domains o LEFT JOIN k ON o.real_domain = k.real_domain WHERE keep IS NULL OR id = keep""")
def _(spark, sf):
    """Copies of listed sites go, but for the row that the list names."""
    rows = planted(spark, sf, "order_domains")
    keep = rows.where("real_domain IS NOT NULL AND id % 2 = 1").groupBy("real_domain").agg(F.max("id").alias("id"))
    return dedupe_real_domain(rows, keep).select("id", "real_domain")


@register("u6_explode_phones", f"""SELECT c_custkey AS domain_id, c_custkey AS seq, unnest(string_split({SQL_PLANTED_PHONES}, ',')) AS number
    FROM customer WHERE {SQL_PLANTED_PHONES} <> ''""")
def _(spark, sf):
    return explode_contacts(extract_features(planted(spark, sf, "page_fetch")))["domain_phones"]


@register("u6_explode_inns", f"SELECT c_custkey AS domain_id, c_custkey AS seq, unnest({SQL_PLANTED_INNS}) AS inn FROM customer")
def _(spark, sf):
    return explode_contacts(extract_features(planted(spark, sf, "page_fetch")))["inns"]


@register("u6_explode_emails", """SELECT c_custkey AS domain_id, c_custkey AS seq, CASE WHEN c_custkey % 2 = 1 THEN 'u' || c_custkey || '@ex' || (c_custkey % 7) || '.com'
    ELSE 'Info' || c_custkey || '@Firm.co.uk' END AS email FROM customer WHERE c_custkey % 2 = 1 OR c_custkey % 6 = 0""")
def _(spark, sf):
    return explode_contacts(extract_features(planted(spark, sf, "page_fetch")))["domain_emails"]


@register("u7_assign_ids", "SELECT 1000 + row_number() OVER (ORDER BY c_mktsegment, c_name) AS id, c_mktsegment, c_name FROM customer")
def _(spark, sf):
    return assign_ids(table(spark, sf, "customer").select("c_mktsegment", "c_name"), 1000, ["c_mktsegment"])
