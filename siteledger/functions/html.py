"""Page features from HTML by regular expressions that run inside the JVM.

Patterns use possessive quantifiers and always find an end, so that a broken
page costs linear time and no stack. ``strip_hidden`` is meant to run once per page; the other
functions take its result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let
from .strings import clean_text, decode_entities

# The rest of a tag after its name. Quoted values may contain ">"; where quotes
# do not match up the tag ends at the next ">", and a tag that never ends takes
# the rest of the page. As some end is always found, a search never starts over.
_REST = r"""(?:(?:[^>"']++|"[^"]*+"|'[^']*+')*+(?:>|\z)|[^>]*+(?:>|\z))"""
# What is never closed hides the rest of the page, as in a parser.
_HIDDEN = (
    r"(?is)<(?:script\b[^>]*+(?:>|\z).*?(?:</script\s*+>|\z)"
    r"|style\b[^>]*+(?:>|\z).*?(?:</style\s*+>|\z)"
    r"|template\b[^>]*+(?:>|\z).*?(?:</template\s*+>|\z)"
    r"|rt\b[^>]*+(?:>|\z).*?(?=</?(?:rt|rp|rb|rtc|ruby)\b|\z)"
    r"|rp\b[^>]*+(?:>|\z).*?(?=</?(?:rt|rp|rb|rtc|ruby)\b|\z)"
    r"|!--.*?(?:-->|\z))"
)
_TAG = rf"(?s)<[/!?a-zA-Z]{_REST}"
_TITLE = r"(?is)<title(?:\s[^>]*+)?(?:>|\z)(?:(.*?)</title\s*+>|.*+)"
_META = rf"(?is)<meta\s{_REST}"
# An anchor ends at its closing tag, at the next anchor or at the end.
_ANCHOR = rf"(?is)<a\s{_REST}.*?(?=<a\s|</a\s*+>|\z)"
_ANCHOR_HEAD = rf"(?is)^<a\s{_REST}"


def strip_hidden(html: Column) -> Column:
    """HTML without scripts, styles, templates, ruby annotations and comments."""
    return F.regexp_replace(html, _HIDDEN, "")


def _attribute(tag: Column, name: str) -> Column:
    """Raw value of an attribute; "" when it is missing."""
    value = F.regexp_extract(tag, rf"""(?is)[\s"']{name}\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++)""", 1)
    return F.regexp_replace(value, r"""(?s)^(["'])(.*)\1$""", "$2")


def title(markup: Column) -> Column:
    """Text of the first title element; "" when there is none."""
    return clean_text(decode_entities(F.regexp_extract(markup, _TITLE, 1)))


def meta_tags(markup: Column) -> Column:
    """All meta tags of the page."""
    return F.regexp_extract_all(markup, F.lit(_META), F.lit(0))


def meta_content(tags: Column, name: str) -> Column:
    """``content`` of the first of the meta tags whose ``name`` is exactly this one."""
    named = F.filter(tags, lambda tag: _attribute(tag, "name") == F.lit(name))
    first = F.try_element_at(named, F.lit(1))
    return F.coalesce(clean_text(decode_entities(_attribute(first, "content"))), F.lit(""))


def description(tags: Column) -> Column:
    """Description out of the ``meta_tags``."""
    return meta_content(tags, "description")


def keywords(tags: Column, limit: int | None = None) -> Column:
    """Keywords out of the ``meta_tags``, or their first ``limit`` characters."""
    whole = meta_content(tags, "keywords")
    return whole if limit is None else F.substring(whole, 1, limit)


def text(markup: Column, sep: str = "") -> Column:
    """All text of the page; pieces between tags are joined by ``sep``."""
    return decode_entities(F.regexp_replace(markup, _TAG, sep))


def links(markup: Column) -> Column:
    """(href, text) of every anchor that has an href, in page order."""

    def link(anchor: Column) -> Column:
        return let(
            F.regexp_extract(anchor, _ANCHOR_HEAD, 0),
            lambda head: F.when(
                F.regexp_like(head, F.lit(r"(?is)[\s\"']href\s*+=")),
                F.struct(
                    decode_entities(_attribute(head, "href")).alias("href"),
                    text(F.substr(anchor, F.length(head) + 1)).alias("text"),
                ),
            ),
        )

    anchors = F.regexp_extract_all(markup, F.lit(_ANCHOR), F.lit(0))
    return F.filter(F.transform(anchors, link), lambda a: a.isNotNull())


def contact_links(markup: Column) -> Column:
    """``links`` of pages that may have ``mailto:`` or ``tel:`` ones, else an empty array."""
    may_have = (
        F.contains(markup, F.lit("mailto:")) | F.contains(markup, F.lit("tel:")) | F.contains(markup, F.lit("&#"))
    )
    return F.when(may_have, links(markup)).otherwise(F.array().cast("array<struct<href string, text string>>"))
