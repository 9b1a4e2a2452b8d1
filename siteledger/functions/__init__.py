"""Column functions; all compose Spark built-ins and stay in the JVM."""

from .cms import CMS_MARKERS, cms
from .contacts import emails, inns, is_valid_inn, phones
from .html import (
    description,
    keywords,
    links,
    meta_content,
    meta_tags,
    strip_hidden,
    text,
    title,
)
from .numbers import python_round2
from .strings import clean_text, company_names, decode_entities, python_strip, sorted_csv
from .urls import bare_host, host_of, is_https, is_www, zone_of

__all__ = [
    "CMS_MARKERS", "bare_host", "clean_text", "cms", "company_names",
    "decode_entities", "description", "emails", "host_of", "inns", "is_https",
    "is_valid_inn", "is_www", "keywords", "links", "meta_content", "meta_tags", "phones",
    "python_round2", "python_strip", "sorted_csv", "strip_hidden", "text",
    "title", "zone_of",
]
