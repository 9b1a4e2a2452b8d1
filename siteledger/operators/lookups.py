"""Joins that enrich sites: regions, phone cities, contact pages, shop probes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import contacts, html
from ..functions.binding import text_list
from ..functions.strings import python_strip
from .sizing import broadcast_if_small, fits_broadcast, staged

CONTACT_KINDS = ("emails", "phones", "inns")
# At most 111,110 prefixes have this many digits or fewer.
SHORT_PREFIX = 5


def category_tags(category: DataFrame, subcategory: DataFrame, tags: DataFrame) -> DataFrame:
    """Category name, subcategory name, tag text and tag id.

    Every subcategory with tags is kept, with or without its category.
    """
    c = broadcast_if_small(category.select(F.col("id").alias("_cid"), F.col("name").alias("category_name")))
    s = subcategory.select("id", F.col("name").alias("subcategory_name"), "category_id")
    named = s.join(c, F.col("category_id") == F.col("_cid"), "left").select(
        F.col("id").alias("_sid"), "category_name", "subcategory_name"
    )
    return tags.join(broadcast_if_small(named), F.col("subcategory_id") == F.col("_sid")).select(
        "category_name", "subcategory_name", "tag", F.col("id").alias("tag_id")
    )


def inn_regions(inns: DataFrame, regions: DataFrame) -> DataFrame:
    """Region of each tax id by its first two digits; ids without one drop out."""
    lookup = regions.select(F.col("id").alias("_region_id"), python_strip(F.col("region")).alias("region"))
    code = F.substring("inn", 1, 2).try_cast("int")
    return inns.join(broadcast_if_small(lookup), code == F.col("_region_id")).drop("_region_id")


def region_names(inns: Column, regions: DataFrame) -> Column:
    """Regions of an array of tax ids, row by row without a join.

    Two digits name at most 100 regions, so the table fits in one literal.
    """
    rows = regions.where(F.col("id").between(0, 99)).select("id", "region").collect()
    names = dict(sorted((r["id"], (r["region"] or "").strip()) for r in rows))
    by_code = text_list([names.get(i) or "" for i in range(100)])
    found = F.transform(inns, lambda n: F.get(by_code, F.substring(n, 1, 2).try_cast("int")))
    return F.filter(found, lambda r: r != F.lit(""))


def phone_locations(phones: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Place of each phone number by the longest prefix known; unknown drops out.

    ``prefixes``: prefix, location, in the 7... form; 8... numbers are read as
    7... ones. One join per prefix length keeps the phones where they are as
    long as the table is small enough to broadcast. Digits of up to
    ``SHORT_PREFIX`` places are few in any table, so these, on which all phones
    would meet, are broadcast in any case; longer ones spread over many keys.
    Empty prefixes match nothing.
    """
    lookup = staged(prefixes.where("prefix rlike '^[0-9]+$'").groupBy("prefix").agg(F.min("location").alias("location")))
    lengths = [r[0] for r in lookup.select(F.length("prefix").alias("n")).distinct().orderBy(F.desc("n")).collect()]  # one row per length
    small = fits_broadcast(lookup)
    number = F.regexp_replace("number", "^8", "7")
    out = phones.withColumn("_number", number)
    for n in lengths:
        side = lookup.where(F.length("prefix") == n).select(
            F.col("prefix").alias(f"_prefix{n}"), F.col("location").alias(f"_location{n}")
        )
        side = F.broadcast(side) if small or n <= SHORT_PREFIX else side
        out = out.join(side, F.substring("_number", 1, n) == F.col(f"_prefix{n}"), "left").drop(f"_prefix{n}")
    best = F.coalesce(*[F.col(f"_location{n}") for n in lengths]) if lengths else F.lit(None).cast("string")
    return out.select(*phones.columns, best.alias("location")).where(F.col("location").isNotNull())


def _contacts(pages: DataFrame, sep: str) -> DataFrame:
    """Contacts of each contact page next to its other columns, html dropped."""
    rest = [c for c in pages.columns if c != "html"]
    marked = pages.select(*rest, html.strip_hidden(F.col("html")).alias("_markup"))
    read = marked.select(*rest, html.text(F.col("_markup"), sep).alias("_text"), html.contact_links(F.col("_markup")).alias("_links"))
    t, a = F.col("_text"), F.col("_links")
    return read.select(
        *rest, contacts.emails(t, a).alias("emails"), contacts.phones(t, a).alias("phones"), contacts.inns(t).alias("inns")
    )


def _items() -> Column:
    """The emails, phones and inns arrays as one array of (kind, value)."""

    def tagged(kind: str) -> Column:
        values = F.coalesce(F.col(kind), F.array().cast("array<string>"))
        return F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))

    return F.concat(*[tagged(kind) for kind in CONTACT_KINDS])


def contact_finds(contact_pages: DataFrame, sep: str = "") -> DataFrame:
    """Distinct (domain_id, kind, value) of all contact pages; kind is emails, phones or inns.

    Only pages with status 200 count, and one failed request drops all contact
    pages of its domain. Contacts are read before any shuffle, so HTML never
    moves, and made distinct on the map side, so that a domain with very many
    pages is no burden to one task.
    """
    pages = contact_pages.where((F.col("status") == 200) & ~F.coalesce(F.col("failed"), F.lit(False)))
    failed = contact_pages.where("failed").select("domain_id").distinct()
    return (
        _contacts(pages.select("domain_id", "html"), sep)
        .select("domain_id", F.explode(_items()).alias("item"))
        .select("domain_id", "item.kind", "item.value")
        .distinct()
        .join(failed, "domain_id", "left_anti")
    )


def merge_contact_pages(main: DataFrame, contact_pages: DataFrame, sep: str = "") -> DataFrame:
    """All contacts of the sites as distinct rows (domain_id, kind, value).

    ``main`` has domain_id, emails, phones and inns of the main pages. Sites
    without an e-mail there also get the finds of their contact pages. Rows
    and not lists, so that no domain has to fit in one cell.
    """
    # Narrow rows of the main pages, staged, so that pages are read once.
    read = staged(main.select("domain_id", (F.size("emails") == 0).alias("_needy"), _items().alias("_items")))
    own = read.select("domain_id", F.explode("_items").alias("item")).select("domain_id", "item.kind", "item.value")
    needy = read.where("_needy").select("domain_id").distinct()
    more = contact_finds(contact_pages, sep).join(needy, "domain_id", "left_semi")
    return own.unionByName(more).distinct()


def shop_flags(sites: DataFrame, probes: DataFrame) -> DataFrame:
    """Add ``is_ecommerce`` and ``has_catalog`` from probe results.

    Only Bitrix sites that are not login pages count. A cart page that answers
    200 makes a shop; a catalog page or a cart makes a catalog. A failed probe
    voids its own group.
    """
    answered, failed = F.col("status") == 200, F.coalesce(F.col("failed"), F.lit(False))

    def group_ok(group: str) -> Column:
        mine = F.col("probe_group") == group
        ok, bad = F.bool_or(mine & answered), F.bool_or(mine & failed)
        return F.coalesce(ok, F.lit(False)) & ~F.coalesce(bad, F.lit(False))

    summary = probes.groupBy(F.col("domain_id").alias("_probe_domain_id")).agg(
        group_ok("cart").alias("_cart"), group_ok("catalog").alias("_catalog")
    )
    # Login pages are recognised by these texts.
    is_candidate = F.coalesce(
        (F.col("cms") == "Bitrix") & ~F.contains("title", F.lit("Авторизация")) & ~F.contains("real_url", F.lit("auth")),
        F.lit(False),
    )
    cart = is_candidate & F.coalesce(F.col("_cart"), F.lit(False))
    catalog = is_candidate & F.coalesce(F.col("_catalog"), F.lit(False))
    return sites.join(summary, F.col("domain_id") == F.col("_probe_domain_id"), "left").select(
        *[F.col(c) for c in sites.columns], cart.alias("is_ecommerce"), (cart | catalog).alias("has_catalog")
    )


def deal_properties(ids: DataFrame, deals: DataFrame, key: str = "id") -> DataFrame:
    """Full deal rows for a list of deal ids."""
    return deals.join(ids.select(key).distinct(), key, "left_semi")


def delete_where(df: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key is not among the ids to delete."""
    return df.join(ids.select(key).distinct(), key, "left_anti")
