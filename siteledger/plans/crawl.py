"""Fetched pages to site tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cms as cms_of
from ..functions.strings import sorted_csv
from ..functions.urls import is_https, is_www
from ..operators.classify import VALID_STATUS, classify_pages, page_status, resolve_status
from ..operators.features import with_contacts, with_texts
from ..operators.lookups import contact_finds, phone_locations, region_names, shop_flags
from ..operators.rules import Rule
from ..operators.sizing import staged
from ..operators.upsert import (
    explode_contacts,
    insert_ignore,
    last_per_key,
    upsert_domain_info,
    upsert_inns,
)
from ..schemas import CONTACT_PAGES, PHONE_PREFIXES, PROBES
from ..sources.partitions import PartitionedTable

ATTEMPT_COLUMNS = ["domain_id", "seq", "http_status", "page_status", "error_kind", "real_url"]


def read_pages(page_fetch: DataFrame, rules: Sequence[Rule] | None = None, sep: str = "") -> DataFrame:
    """One narrow row of features per fetch attempt, HTML and text dropped.

    Attempts without a page have NULL features. Contacts are only looked for
    on valid pages.
    """
    is_page = F.col("error_kind").isNull() & (F.col("http_status") == VALID_STATUS)
    redirect = is_https(F.col("real_url"))
    base = page_fetch.select(
        "domain_id", "domain", F.coalesce("zone", F.lit("ru")).alias("zone"), "seq", "http_status", "error_kind",
        "real_url", "ip", "hosting", "country",
        F.when(is_page, F.col("html")).alias("html"),
        redirect.alias("is_https_redirect"),
        F.coalesce(is_https(F.col("https_real_url")), redirect).alias("is_ssl"),
        is_www(F.col("real_url")).alias("is_www"),
        F.coalesce(is_page, F.lit(False)).alias("is_page"),
    )
    texts = with_texts(base, sep=sep).withColumn("cms", cms_of(F.col("html")))
    judged = page_status(classify_pages(texts.drop("html"), rules)).withColumns(
        {c: F.when(F.col("is_page"), F.col(c)) for c in ("junk_status", "banword", "page_status")}
    )
    return with_contacts(judged, F.col("page_status") == VALID_STATUS, all_links=False).drop("_markup", "text", "links")


def last_pages(features: DataFrame) -> DataFrame:
    """The last valid page of each site, with ``first_seq`` of its first one."""
    return last_per_key(features.where(F.col("page_status") == VALID_STATUS), ["domain_id"], "seq", "first_seq")


def site_rows(
    last: DataFrame, finds: DataFrame, probes: DataFrame, regions: DataFrame, prefixes: DataFrame
) -> DataFrame:
    """Last pages with city, tax ids of the contact pages and shop flags."""
    # The city comes from the main page alone, before contact pages add to it.
    numbers = last.where(F.size("inns") == 0).select("domain_id", F.explode("phones").alias("number"))
    cities = phone_locations(numbers, prefixes).groupBy("domain_id").agg(
        F.array_sort(F.collect_set("location")).alias("_places")
    )
    more = finds.where(F.col("kind") == "inns").groupBy("domain_id").agg(F.collect_list("value").alias("_more"))
    none = F.array().cast("array<string>")
    city = F.when(F.size("inns") > 0, region_names(F.col("inns"), regions)).otherwise(F.coalesce("_places", none))
    inns = F.when(F.size("emails") == 0, F.array_union("inns", F.coalesce("_more", none))).otherwise(F.col("inns"))
    merged = last.join(cities, "domain_id", "left").join(more, "domain_id", "left").select(
        *[inns.alias("inns") if c == "inns" else F.col(c) for c in last.columns], city.alias("cities")
    )
    return shop_flags(merged, probes)


def contact_rows(features: DataFrame, finds: DataFrame) -> dict[str, DataFrame]:
    """Rows for the contact tables: finds of every valid page and of contact pages.

    Contact pages count for sites with a valid page without e-mail. Tax ids
    come at the first and the last such page, as their owner is the last site.
    """
    valid = features.where(F.col("page_status") == VALID_STATUS)
    needy = valid.where(F.size("emails") == 0).groupBy("domain_id").agg(
        F.min("seq").alias("_first"), F.max("seq").alias("_last")
    )
    more = finds.join(needy, "domain_id").select(
        "domain_id", "kind", "value", F.explode(F.array_distinct(F.array("_first", "_last"))).alias("seq")
    )
    tables = explode_contacts(valid)
    kinds = {"domain_phones": "phones", "domain_emails": "emails", "domain_inns": "inns", "inns": "inns"}
    for name, kind in kinds.items():
        rows = tables[name]
        value = next(c for c in rows.columns if c not in ("domain_id", "seq"))
        extra = more.where(F.col("kind") == kind).select("domain_id", "seq", F.col("value").alias(value))
        tables[name] = rows.unionByName(extra)
    return tables


def domain_info_rows(sites: DataFrame, run_date: str) -> DataFrame:
    """Sites as rows of domain_info."""
    return sites.select(
        "domain_id", F.col("real_url").alias("real_domain"), "title", "description", "keywords",
        sorted_csv(F.col("cities")).alias("city"), sorted_csv(F.col("inns")).alias("inn"), "cms",
        F.coalesce("hosting", F.lit("")).alias("hosting"), "is_ssl", "is_www", "is_https_redirect",
        F.coalesce("ip", F.lit("")).alias("ip"), F.coalesce("country", F.lit("")).alias("country"),
        # Columns every row gets alike.
        F.lit(0).alias("tag_id"), F.lit("").alias("license_type"),
        "is_ecommerce", "has_catalog", F.lit(run_date).cast("date").alias("last_updated"), "seq", "first_seq",
    )


class SiteTables(Mapping):
    """The tables of a crawl by name; each is planned when it is first asked for."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        self._makers, self._made = makers, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self):
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def build_tables(
    tables: Mapping[str, DataFrame | PartitionedTable],
    features: DataFrame,
    *,
    regions: DataFrame,
    run_date: str,
    contact_pages: DataFrame | None = None,
    probes: DataFrame | None = None,
    prefixes: DataFrame | None = None,
    sep: str = "",
    names: PartitionedTable | None = None,
    above: Mapping[str, int] | None = None,
) -> SiteTables:
    """Fold features of ``read_pages`` into the site tables.

    ``features`` is read several times: pass a written table. Gives the new
    tables plus ``domain_info_rejects`` and ``inns_rejects``, each planned on
    request; what several of them need is staged once.

    Where a table is partitioned, only the partitions that the new rows touch are
    read and come out. For domain_info these are those of the sites and of the
    owners of their addresses, which ``names`` (real_domain, domain_id) tells;
    ``above`` is then the highest id in use of each table.
    """
    spark, above = features.sparkSession, above or {}

    def near(name: str, rows: DataFrame, key: str) -> DataFrame:
        """The rows of a table that new rows can meet."""
        return tables[name].near(rows, key) if isinstance(tables[name], PartitionedTable) else tables[name]

    def given(df: DataFrame | None, schema) -> DataFrame:
        return spark.createDataFrame([], schema) if df is None else df

    @cache
    def finds() -> DataFrame:
        return staged(contact_finds(given(contact_pages, CONTACT_PAGES), sep))

    @cache
    def info() -> tuple[DataFrame, DataFrame]:
        sites = site_rows(staged(last_pages(features)), finds(), given(probes, PROBES), regions, given(prefixes, PHONE_PREFIXES))
        rows = staged(domain_info_rows(sites, run_date))
        wanted = rows.select("domain_id", "real_domain")
        if names is not None:
            owners = names.near(wanted, "real_domain").join(wanted.select("real_domain").distinct(), "real_domain")
            wanted = wanted.unionByName(owners.select("domain_id", "real_domain"))
        return upsert_domain_info(near("domain_info", wanted, "domain_id"), rows, "seq", first_seq="first_seq", id_col="id", above=above.get("domain_info", 0))

    @cache
    def found() -> dict[str, DataFrame]:
        return contact_rows(features, finds())

    # Among the tax ids of one site the lowest counts as found first.
    order = F.struct("seq", "inn")

    @cache
    def inns() -> tuple[DataFrame, DataFrame]:
        rows = found()["inns"].withColumn("seq", order)
        return upsert_inns(near("inns", rows, "inn"), rows, "seq", id_col="id", above=above.get("inns", 0))

    def kept_first(name: str, *keys: str) -> Callable[[], DataFrame]:
        def make() -> DataFrame:
            rows = found()[name]
            existing = near(name, rows, "domain_id")
            return insert_ignore(existing, rows.withColumn("seq", order) if name == "domain_inns" else rows, list(keys), "seq", "id", above.get(name, 0))

        return make

    return SiteTables({
        "domains": lambda: resolve_status(near("domains", features, "domain_id"), features.select(*ATTEMPT_COLUMNS)),
        # A CRM label that a crawl never changes; new sites start with this one.
        "domain_info": lambda: info()[0].withColumn("status", F.coalesce("status", F.lit("Отсутствует"))),
        "domain_phones": kept_first("domain_phones", "domain_id", "number"),
        "domain_emails": kept_first("domain_emails", "domain_id", "email"),
        "domain_inns": kept_first("domain_inns", "domain_id"),
        "inns": lambda: inns()[0],
        "domain_info_rejects": lambda: info()[1],
        "inns_rejects": lambda: inns()[1].withColumn("seq", F.col("seq.seq")),
    })


def crawl(
    tables: dict[str, DataFrame], page_fetch: DataFrame, *, rules: Sequence[Rule] | None = None, sep: str = "", **inputs
) -> SiteTables:
    """Batch job: read all pages once, then fold them into the tables."""
    return build_tables(tables, staged(read_pages(page_fetch, rules, sep)), sep=sep, **inputs)
