"""Streaming feeds."""

from .pages import REJECTS, SITE_TABLES, refresh_tables, site_table, stream_pages

__all__ = ["REJECTS", "SITE_TABLES", "refresh_tables", "site_table", "stream_pages"]
