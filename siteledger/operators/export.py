"""Rows for the CRM: field codes, update payloads and parameter strings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import bare_host

# CRM code of each field.
CRM_FIELDS = {
    # standard fields
    "id": "ID",
    "title": "TITLE",
    "dealType": "TYPE_ID",
    "categoryID": "CATEGORY_ID",
    "stageID": "STAGE_ID",
    "stageSemanticID": "STAGE_SEMANTIC_ID",
    "isNew": "IS_NEW",
    "isRecurring": "IS_RECURRING",
    "isReturnCustomer": "IS_RETURN_CUSTOMER",
    "isRepeatedApproach": "IS_REPEATED_APPROACH",
    "probability": "PROBABILITY",
    "currencyID": "CURRENCY_ID",
    "opportunity": "OPPORTUNITY",
    "isManualOpportunity": "IS_MANUAL_OPPORTUNITY",
    "taxValue": "TAX_VALUE",
    "companyID": "COMPANY_ID",
    "contactID": "CONTACT_ID",
    "contactIDS": "CONTACT_IDS",
    "quoteID": "QUOTE_ID",
    "assignedByID": "ASSIGNED_BY_ID",
    "createdByID": "CREATED_BY_ID",
    "modifyByID": "MODIFY_BY_ID",
    "leadID": "LEAD_ID",
    # custom fields
    "realDomain": "UF_CRM_1656402341",
    "siteTitle": "UF_CRM_1655668897",
    "siteDescription": "UF_CRM_1655668911",
    "keywords": "UF_CRM_1655668926",
    "category": "UF_CRM_1655194508",
    "region": "UF_CRM_1655194854",
    "cms": "UF_CRM_1655194921",
    "subcategory": "UF_CRM_1655200162",
    "isSsl": "UF_CRM_1655303903",
    "isWWW": "UF_CRM_1655303925",
    "ip": "UF_CRM_1655303954",
    "isHttpsRedirect": "UF_CRM_1655669236",
    "email": "UF_CRM_1655722376",
    "inn": "UF_CRM_1655722387",
    "phone": "UF_CRM_1655723513",
    "domainInfoID": "UF_CRM_1655814173",
    "migrationDate": "UF_CRM_1656327420",
    "segment": "UF_CRM_1656332862",
    "income": "UF_CRM_1656340157",
    "outcome": "UF_CRM_1656342316",
    "profit": "UF_CRM_1656342388",
    "companyFullName": "UF_CRM_1656513508",
    "companyType": "UF_CRM_1656513708",
    "legalAddress": "UF_CRM_1656513847",
    "postIndex": "UF_CRM_1656513996",
    "registryDate": "UF_CRM_1656514240",
    "bossName": "UF_CRM_1656514500",
    "bossPost": "UF_CRM_1656514646",
    "yandexMapsUrl": "UF_CRM_1656514823",
    "googleMapsUrl": "UF_CRM_1656515194",
    "authorizedCapitalAmount": "UF_CRM_1656515462",
    "registrationDate": "UF_CRM_1656515867",
    "registryType": "UF_CRM_1656516267",
    "employeeCount": "UF_CRM_1656516423",
    "mainActivityType": "UF_CRM_1656516561",
    "lastFinanceYear": "UF_CRM_1656516726",
    "founders": "UF_CRM_1656517374",
    "founderInns": "UF_CRM_1656517545",
    "founderParts": "UF_CRM_1656517752",
    "hosting": "UF_CRM_1656517982",
    "isInn": "UF_CRM_1656532638",
    "isEcommerce": "UF_CRM_1656938541",
    "isCatalog": "UF_CRM_1657794158",
    "hostingCountry": "UF_CRM_1657794396",
}


def crm_code(field: str, mapping: Mapping[str, str] = CRM_FIELDS) -> str:
    if field not in mapping:
        raise KeyError(f"no CRM field named {field}")
    return mapping[field]


def crm_rename(df: DataFrame, mapping: Mapping[str, str] = CRM_FIELDS) -> DataFrame:
    """Every column under its CRM code; an unknown column is an error."""
    return df.select(*[F.col(f"`{c}`").alias(crm_code(c, mapping)) for c in df.columns])


def deal_updates(deals: DataFrame, fields: Sequence[str] = ("title",)) -> DataFrame:
    """(id, fields) per deal: its title becomes the bare host of its site, other fields their columns."""
    values = {f: bare_host(F.col("real_domain")) if f == "title" else F.col(f).cast("string") for f in fields}
    pairs = [x for f, value in values.items() for x in (F.lit(crm_code(f)), value)]
    return deals.select(F.col("bitrix_id").alias("id"), F.create_map(*pairs).alias("fields"))


def contact_updates(deals: DataFrame, contacts: DataFrame) -> DataFrame:
    """(id, fields) per contact of a deal: last name becomes the deal's new title."""
    # Fixed value: CRM code of a contact's last name.
    name = F.create_map(F.lit("LAST_NAME"), bare_host(F.col("real_domain")))
    return deals.join(contacts, "bitrix_id").select(F.col("contact_id").alias("id"), name.alias("fields"))


def crm_params(updates: DataFrame, *, url_encode: bool = False) -> DataFrame:
    """(id, params) with the parameter string ``.json?id=1&fields[K]=V&``."""
    pairs = F.transform(
        F.map_entries("fields"),
        lambda e: F.concat(
            F.lit("fields["), e["key"], F.lit("]="), F.url_encode(e["value"]) if url_encode else e["value"], F.lit("&")
        ),
    )
    return updates.select(
        "id", F.concat(F.lit(".json?id="), F.col("id").cast("string"), F.lit("&"), F.array_join(pairs, "")).alias("params")
    )


def deal_fields(df: DataFrame, fields: Sequence[str], id_col: str = "id") -> DataFrame:
    """(id, fields) from columns named like CRM fields."""
    entries = [x for f in fields for x in (F.lit(crm_code(f)), F.col(f).cast("string"))]
    return df.select(F.col(id_col).alias("id"), F.create_map(*entries).alias("fields"))
