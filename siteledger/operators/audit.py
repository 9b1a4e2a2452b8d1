"""Audit records of deletions, of junk Bitrix sites, and run counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def audit_deleted(deleted: DataFrame, limit: int | None = None) -> DataFrame:
    """Ids, real_domain, title and description, or the first ``limit`` characters of both."""
    texts = [F.col(c) if limit is None else F.substring(c, 1, limit).alias(c) for c in ("title", "description")]
    return deleted.select("id", "domain_id", "real_domain", *texts)


def audit_invalid_cms(pages: DataFrame, status: int = 228) -> DataFrame:
    """Junk pages found on a Bitrix site: url, status and the pattern that hit."""
    return pages.where(F.col("page_status") == status).select("real_url", "page_status", "banword")


def with_run_counters(df: DataFrame, name: str, **counters: Column) -> tuple[DataFrame, Observation]:
    """Count rows and the given aggregates while the data is written anyway."""
    seen = Observation(name)
    return df.observe(seen, F.count("*").alias("rows"), *[c.alias(n) for n, c in counters.items()]), seen
