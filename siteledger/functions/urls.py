"""URL and domain-name helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zone_of(domain: Column) -> Column:
    """Everything after the first dot; "" when there is none."""
    return F.regexp_replace(domain, r"^[^.]*\.?", "")


def host_of(url: Column) -> Column:
    """Host part of an absolute URL, lower-cased; "" when there is none."""
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#:]*)", 1))


def bare_host(url: Column) -> Column:
    """Text between the first and second colon without slashes at its ends."""
    return F.trim(F.split_part(url, F.lit(":"), F.lit(2)), F.lit("/"))


def is_www(url: Column) -> Column:
    return F.contains(url, F.lit("www."))


def is_https(url: Column) -> Column:
    return F.contains(url, F.lit("https://"))
