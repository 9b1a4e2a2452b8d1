"""Jobs wired from the operators."""

from .cleanup import clean_up
from .crawl import SiteTables, build_tables, crawl, read_pages
from .loads import load_domain_inns, load_domains, load_inns
from .registry import load_registry

__all__ = [
    "SiteTables", "build_tables", "clean_up", "crawl", "load_domain_inns", "load_domains", "load_inns", "load_registry", "read_pages",
]
