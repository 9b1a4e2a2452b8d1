"""Filters, bounds and bounded reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def portion(df: DataFrame, from_id: int, limit: int, *, inclusive: bool = True, key: str = "id") -> DataFrame:
    """The next ``limit`` rows by id, starting at or after ``from_id``."""
    start = F.col(key) >= from_id if inclusive else F.col(key) > from_id
    return df.where(start).orderBy(key).limit(limit)


def retry_set(domains: DataFrame, status: int, from_id: int = 0, limit: int | None = None) -> DataFrame:
    """Domains to fetch again: those with this status, from an id on."""
    rows = domains.where((F.col("status") == status) & (F.col("id") >= from_id))
    return rows if limit is None else rows.orderBy("id").limit(limit)


def id_bounds(df: DataFrame, key: str = "id") -> DataFrame:
    """One row: first id, last id, number of rows."""
    return df.agg(F.min(key).alias("first_id"), F.max(key).alias("last_id"), F.count("*").alias("n"))


def search_domains(domains: DataFrame, info: DataFrame, like: str) -> DataFrame:
    """Domains matching a LIKE pattern whose info row has a CRM id."""
    return (
        domains.where(F.col("domain").like(like))
        .select("id", "domain", "real_domain")
        .join(
            info.where(F.col("bitrix_id").isNotNull()).select("domain_id", "bitrix_id"),
            F.col("id") == F.col("domain_id"),
        )
        .select("domain", "real_domain", "bitrix_id")
    )


def with_domain(inns: DataFrame) -> DataFrame:
    """Tax ids that belong to a domain."""
    return inns.where(F.col("domain_id").isNotNull())


def first_n(df: DataFrame, n: int, key: str = "id") -> DataFrame:
    """The first ``n`` rows by key."""
    return df.orderBy(key).limit(n)
