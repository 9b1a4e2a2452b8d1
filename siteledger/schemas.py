"""Columns of every table and input, with the declared keys and lengths."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "bigint": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "boolean": T.BooleanType(),
    "double": T.DoubleType(), "date": T.DateType(),
}


def _schema(columns: str) -> T.StructType:
    """Schema of "name type, name type"; needs no running session."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


TABLES = {
    "domains": _schema("id bigint, domain string, zone string, real_domain string, status int"),
    "domain_info": _schema(
        "id bigint, domain_id bigint, real_domain string, title string, description string, keywords string, "
        "city string, inn string, cms string, hosting string, is_ssl boolean, is_www boolean, "
        "is_https_redirect boolean, ip string, country string, tag_id int, status string, comment string, "
        "is_ecommerce boolean, has_catalog boolean, license_type string, bitrix_id bigint, last_updated date, "
        "last_migrated_to_bitrix date"
    ),
    "domain_phones": _schema("id bigint, domain_id bigint, number string"),
    "domain_emails": _schema("id bigint, domain_id bigint, email string"),
    "domain_inns": _schema("id bigint, inn string, domain_id bigint"),
    "inns": _schema("id bigint, inn string, domain_id bigint"),
    "company_info": _schema(
        "inn_id bigint, inn string, name string, type string, segment int, region string, city string, "
        "address string, post_index string, registration_date date, boss_name string, boss_post string, "
        "yandex_reviews string, google_reviews string, authorized_capital_amount string, registry_date date, "
        "registry_category string, employees_number int, main_activity string, last_finance_year int"
    ),
    "company_finances": _schema("inn_id bigint, inn string, year int, income double, outcome double, profit double"),
    "company_founders": _schema(
        "inn_id bigint, inn string, founder_full_name string, founder_inn string, "
        "founder_capital_part_amount string, founder_capital_part_percent double"
    ),
    "company_additional_activities": _schema(
        "inn_id bigint, inn string, activity_code string, activity_name string, activity_version string"
    ),
    "additional_activities": _schema("id bigint, name string, code string"),
    "regions": _schema("id int, region string"),
    "category": _schema("id int, name string"),
    "subcategory": _schema("id int, name string, category_id int"),
    "tags": _schema("id int, tag string, subcategory_id int"),
}

# Declared unique keys besides the id.
UNIQUE_KEYS = {
    "domains": [["domain"]],
    "domain_info": [["domain_id"], ["real_domain"]],
    "domain_phones": [["domain_id", "number"]],
    "domain_emails": [["domain_id", "email"]],
    "domain_inns": [["domain_id"]],
    "inns": [["inn"]],
    "company_info": [["inn_id"]],
    "company_finances": [["inn_id", "year"]],
    "company_founders": [["inn_id", "founder_full_name"]],
    "company_additional_activities": [["inn_id", "activity_code"]],
}

# Declared string lengths.
LENGTHS = {
    "domains": {"domain": 255, "zone": 100, "real_domain": 255},
    "domain_info": {
        "real_domain": 255, "inn": 255, "cms": 100, "hosting": 100, "ip": 20, "country": 50, "status": 30,
        "license_type": 50,
    },
    "domain_phones": {"number": 20},
    "domain_emails": {"email": 255},
    "domain_inns": {"inn": 20},
    "inns": {"inn": 20},
    "company_info": {
        "name": 1000, "type": 1000, "region": 500, "city": 255, "address": 255, "post_index": 20,
        "boss_name": 255, "boss_post": 255, "yandex_reviews": 500, "google_reviews": 500,
        "authorized_capital_amount": 255, "registry_category": 255, "main_activity": 255,
    },
    "company_founders": {"founder_full_name": 255, "founder_inn": 20, "founder_capital_part_amount": 255},
    "company_additional_activities": {"activity_code": 10},
}

# Declared NOT NULL columns besides the id.
NOT_NULL = {
    "inns": ["inn"],
    "company_finances": ["inn_id"],
    "category": ["name"],
    "subcategory": ["category_id"],
}

# child table, foreign key, parent table, parent key
FOREIGN_KEYS = [
    ("domain_info", "domain_id", "domains", "id"),
    ("domain_info", "tag_id", "tags", "id"),
    ("domain_phones", "domain_id", "domains", "id"),
    ("domain_emails", "domain_id", "domains", "id"),
    ("domain_inns", "domain_id", "domains", "id"),
    ("inns", "domain_id", "domains", "id"),
    ("company_info", "inn_id", "inns", "id"),
    ("company_finances", "inn_id", "inns", "id"),
    ("company_founders", "inn_id", "inns", "id"),
    ("company_additional_activities", "inn_id", "company_info", "inn_id"),
    ("subcategory", "category_id", "category", "id"),
    ("tags", "subcategory_id", "subcategory", "id"),
]

# Which sites have or had an address: finds the partition of an address's owner.
DOMAIN_NAMES = _schema("real_domain string, domain_id bigint")

PAGE_FETCH = _schema(
    "domain_id bigint, domain string, zone string, previous_status int, http_status int, real_url string, "
    "https_real_url string, error_kind string, html string, ip string, hosting string, country string, seq bigint"
)
CONTACT_PAGES = _schema("domain_id bigint, section string, status int, failed boolean, html string")
PROBES = _schema("domain_id bigint, probe_group string, section string, status int, failed boolean")
REGISTRY_DOCS = _schema("inn_id bigint, inn string, doc string")
PHONE_PREFIXES = _schema("prefix string, location string")
INN_ROWS = _schema("inn string, domain_id bigint")
DEALS = _schema("bitrix_id bigint, real_domain string")
