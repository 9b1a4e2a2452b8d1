"""CRM export (E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from siteledger.operators import contact_updates, crm_params, crm_rename, deal_fields, deal_updates

from . import register, table


@register("e1_crm_rename", """SELECT o_orderkey AS "ID", o_orderstatus AS "TITLE", o_totalprice AS "OPPORTUNITY", o_orderpriority AS "UF_CRM_1656332862" FROM orders""")
def _(spark, sf):
    named = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("title"), F.col("o_totalprice").alias("opportunity"), F.col("o_orderpriority").alias("segment")
    )
    return crm_rename(named)


def _deals(spark, sf):
    return table(spark, sf, "pages").select(F.col("page_id").alias("bitrix_id"), F.col("url").alias("real_domain"))


@register("e2_deal_updates", """SELECT page_id AS id, trim(split_part(url, ':', 2), '/') AS title FROM pages""")
def _(spark, sf):
    return deal_updates(_deals(spark, sf)).select("id", F.col("fields")["TITLE"].alias("title"))


@register("e2_deal_fields", """SELECT page_id AS id, trim(split_part(url, ':', 2), '/') AS title, CAST(page_id % 10 AS STRING) AS segment, 'x' || page_id AS opportunity FROM pages""")
def _(spark, sf):
    deals = _deals(spark, sf).select("*", (F.col("bitrix_id") % 10).alias("segment"), F.concat(F.lit("x"), "bitrix_id").alias("opportunity"))
    fields = F.col("fields")
    return deal_updates(deals, ["title", "segment", "opportunity"]).select(
        "id", fields["TITLE"].alias("title"), fields["UF_CRM_1656332862"].alias("segment"), fields["OPPORTUNITY"].alias("opportunity")
    )


@register("e2_contact_updates", """SELECT o_orderkey AS id, trim(split_part(url, ':', 2), '/') AS last_name FROM pages JOIN orders ON o_custkey = page_id""")
def _(spark, sf):
    contacts = table(spark, sf, "orders").select(F.col("o_custkey").alias("bitrix_id"), F.col("o_orderkey").alias("contact_id"))
    return contact_updates(_deals(spark, sf), contacts).select("id", F.col("fields")["LAST_NAME"].alias("last_name"))


@register("e3_crm_params", """SELECT o_orderkey AS id, '.json?id=' || o_orderkey || '&fields[TITLE]=' || o_orderstatus || '&fields[UF_CRM_1656332862]=' || o_orderpriority || '&' AS params FROM orders""")
def _(spark, sf):
    named = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("title"), F.col("o_orderpriority").alias("segment"))
    return crm_params(deal_fields(named, ["title", "segment"]))


@register("e3_deal_params", """SELECT page_id AS id, '.json?id=' || page_id || '&fields[TITLE]=' || trim(split_part(url, ':', 2), '/') || '&' AS params FROM pages""")
def _(spark, sf):
    return crm_params(deal_updates(_deals(spark, sf)))
