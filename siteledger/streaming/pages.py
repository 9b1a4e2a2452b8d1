"""Page feed: the same tables as the batch job, kept up to date from new files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rules import Rule
from ..operators.sizing import staged
from ..operators.upsert import insert_ignore
from ..plans.crawl import build_tables, read_pages
from ..schemas import DOMAIN_NAMES, PAGE_FETCH, TABLES
from ..sources.partitions import PARTS, PartitionedTable
from ..sources.tables import announce, latest_snapshot

# The tables of the feed, with the column by which each is partitioned.
SITE_TABLES = {"domains": "id", "domain_info": "domain_id", "domain_phones": "domain_id", "domain_emails": "domain_id", "domain_inns": "domain_id", "inns": "inn"}
REJECTS = ("domain_info_rejects", "inns_rejects")


def site_table(spark: SparkSession, root: str, name: str, parts: int = PARTS) -> PartitionedTable:
    """A table of the feed; ``parts`` counts for its first write only."""
    return PartitionedTable(spark, root, name, TABLES[name], (SITE_TABLES[name],), parts)


def stream_pages(
    spark: SparkSession, in_dir: str, root: str, checkpoint: str, *, rules: Sequence[Rule] | None = None,
    sep: str = "", max_files: int = 1000,
) -> int:
    """Read all new page files into the feature log; returns the last batch id.

    A batch writes only its own folder of the log, so its cost follows the
    batch and not the tables, and running it again replaces the same folder.
    """

    def log_features(batch: DataFrame, batch_id: int) -> None:
        read_pages(batch, rules, sep).write.mode("overwrite").parquet(f"{root}/features/batch_id={batch_id}")
        announce(batch.sparkSession, root, "features", batch_id)

    pages = spark.readStream.schema(PAGE_FETCH).option("maxFilesPerTrigger", max_files).parquet(in_dir)
    query = (
        pages.writeStream.foreachBatch(log_features)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    last = latest_snapshot(spark, root, "features")
    return -1 if last is None else last


def refresh_tables(spark: SparkSession, root: str, parts: int = PARTS, **inputs) -> int:
    """Fold the logged batches since the last refresh into the tables.

    Only partitions that hold a site, address or tax id of these batches are read
    and replaced, so a refresh costs what it changes and not what the tables are,
    however many small batches came in between. Rejected rows go to the records
    of their kind, in a folder per refresh. A refresh that broke off is simply run
    again: folding a batch into a table that already has it changes nothing.
    """
    upto, base = latest_snapshot(spark, root, "features"), latest_snapshot(spark, root, "refresh")
    if upto is None or upto == base:
        return -1 if upto is None else upto
    first = 0 if base is None else base + 1
    features = spark.read.parquet(f"{root}/features").where(F.col("batch_id").between(first, upto)).drop("batch_id")
    tables = {name: site_table(spark, root, name, parts) for name in SITE_TABLES}
    names = PartitionedTable(spark, root, "domain_names", DOMAIN_NAMES, ("real_domain",), parts)
    above = {name: latest_snapshot(spark, root, f"{name}.ids") or 0 for name in SITE_TABLES}
    new = build_tables(tables, features, names=names, above=above, **inputs)
    # All is planned from the tables as they were, and rejects are kept, before any of them changes.
    made = {name: staged(new[name]) for name in [*SITE_TABLES, *REJECTS]}
    # Addresses first: one that is listed and not yet taken does no harm.
    held = made["domain_info"].where("real_domain IS NOT NULL").select("real_domain", "domain_id").distinct().withColumn("seq", F.lit(0))
    names.replace(insert_ignore(names.near(held, "real_domain"), held, ["real_domain", "domain_id"], "seq"))
    for name, table in tables.items():
        # Highest ids are recorded before they are in use.
        announce(spark, root, f"{name}.ids", max(above[name], made[name].agg(F.max("id")).first()[0] or 0))
        table.put(made[name])
    for name in REJECTS:
        made[name].write.mode("overwrite").parquet(f"{root}/records/{name}/refresh={upto}")
    announce(spark, root, "refresh", upto)
    return upto
