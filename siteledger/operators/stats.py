"""Report queries over the site tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cms_counts(info: DataFrame) -> DataFrame:
    """Sites per CMS, most used first; the NULL group counts 0."""
    return info.groupBy("cms").agg(F.count("cms").alias("count")).orderBy(F.desc("count"), "cms")


def status_counts(domains: DataFrame) -> DataFrame:
    """Domains per status."""
    return domains.groupBy("status").agg(F.count("*").alias("count"))


def count_status(domains: DataFrame, status: int) -> DataFrame:
    """Number of domains with this status, e.g. 408 (timeout) or 228 (junk Bitrix)."""
    return domains.where(F.col("status") == status).agg(F.count("*").alias("count"))


def real_domain_counts(domains: DataFrame) -> DataFrame:
    """Domains per real_domain, most used first."""
    return (
        domains.groupBy("real_domain")
        .agg(F.count("real_domain").alias("domain_count"))
        .orderBy(F.desc("domain_count"), "real_domain")
    )


def real_domain_copies(info: DataFrame) -> DataFrame:
    """real_domains held by more than one row, most copies first."""
    return real_domain_counts(info).where(F.col("domain_count") > 1)


def column_counts(df: DataFrame, column: str) -> DataFrame:
    """One row: count of rows and of rows where the column is set."""
    return df.agg(F.count("*").alias("n_rows"), F.count(column).alias("n_values"))
