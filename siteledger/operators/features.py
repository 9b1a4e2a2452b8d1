"""All page features in one narrow pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cms as cms_of
from ..functions import contacts, html
from ..functions.urls import is_www


def with_texts(pages: DataFrame, html_col: str = "html", sep: str = "") -> DataFrame:
    """Add title, description, keywords, text and the script-free ``_markup``."""
    markup, tags = F.col("_markup"), F.col("_meta_tags")
    marked = pages.select("*", html.strip_hidden(F.col(html_col)).alias("_markup"))
    return marked.select("*", html.meta_tags(markup).alias("_meta_tags")).select(
        "*",
        html.title(markup).alias("title"),
        html.description(tags).alias("description"),
        html.keywords(tags).alias("keywords"),
        html.text(markup, sep).alias("text"),
    ).drop("_meta_tags")


def with_contacts(pages: DataFrame, only: Column | None = None, all_links: bool = True) -> DataFrame:
    """Add links, emails, phones and inns; rows outside ``only`` get NULLs at no cost.

    Without ``all_links`` the links are read only where a contact may be in them.
    """

    def guarded(value: Column) -> Column:
        return value if only is None else F.when(only, value)

    # Each step is its own projection, so that the costly columns are computed
    # once although later ones use them several times.
    links = html.links if all_links else html.contact_links
    return pages.select("*", guarded(links(F.col("_markup"))).alias("links")).select(
        "*",
        guarded(contacts.emails(F.col("text"), F.col("links"))).alias("emails"),
        guarded(contacts.phones(F.col("text"), F.col("links"))).alias("phones"),
        guarded(contacts.inns(F.col("text"))).alias("inns"),
    )


def extract_features(pages: DataFrame, html_col: str = "html", url_col: str = "real_url", sep: str = "") -> DataFrame:
    """Add title, description, keywords, text, links, emails, phones, inns, cms, is_www.

    Rows stay where they are: no shuffle, no Python.
    """
    return (
        with_contacts(with_texts(pages, html_col, sep))
        .withColumns({"cms": cms_of(F.col(html_col)), "is_www": is_www(F.col(url_col))})
        .drop("_markup")
    )
