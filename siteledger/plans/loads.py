"""Load jobs: lists of domains and tax ids from files into their tables, keeping what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.upsert import insert_ignore, upsert_inns
from ..sources.files import read_domains_csv, read_inns_csv, read_json_rows


def load_domains(domains: DataFrame, path: str) -> DataFrame:
    """The domains of a CSV added to the table ``domains``, new ones with the next ids and no status."""
    rows = read_domains_csv(domains.sparkSession, path).withColumn("seq", F.col("domain"))
    return insert_ignore(domains, rows, ["domain"], "seq", "id")


def load_inns(inns: DataFrame, path: str, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The tax ids of a CSV added to the table ``inns`` without an owner: (new table, ids that were known)."""
    rows = read_inns_csv(inns.sparkSession, path, limit).select("inn", F.lit(None).cast("bigint").alias("domain_id"), F.col("inn").alias("seq"))
    table, known = upsert_inns(inns, rows, "seq", id_col="id")
    return table, known.select("inn")


def load_domain_inns(domain_inns: DataFrame, path: str) -> DataFrame:
    """The (inn, domain_id) rows of JSON files added to ``domain_inns``; the lowest tax id of a new domain stays."""
    rows = read_json_rows(domain_inns.sparkSession, path).where("domain_id IS NOT NULL").withColumn("seq", F.col("inn"))
    return insert_ignore(domain_inns, rows, ["domain_id"], "seq", "id")
