"""Domain, tax-id and JSON files."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.urls import zone_of
from ..operators.filters import with_domain
from ..schemas import INN_ROWS


def with_row_number(df: DataFrame, name: str = "id") -> DataFrame:
    """Number the rows of a file read 0, 1, 2, ... in file order.

    One pass counts the rows of each file block, a second one adds the
    position inside the block; rows are not moved. Only one count per block
    is brought together and sent to the tasks.
    """
    marked = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_mono"),
    )
    blocks = marked.groupBy("_file", "_start").agg(F.min("_mono").alias("_low"), F.count("*").alias("_n"))
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "_file", "_start", "_low", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    position = F.col("_offset") + F.col("_mono") - F.col("_low")
    return marked.join(F.broadcast(offsets), ["_file", "_start"]).select(
        position.alias(name), *[F.col(f"`{c}`") for c in df.columns]
    )


def domain_rows(domains: DataFrame) -> DataFrame:
    """Distinct ``domain`` values with their ``zone``."""
    return domains.select("domain").distinct().withColumn("zone", zone_of(F.col("domain")))


def read_domains_csv(spark: SparkSession, path: str) -> DataFrame:
    """(domain, zone) of a CSV with the header ``domain``, without duplicates."""
    return domain_rows(spark.read.option("header", True).csv(path))


def read_domains_txt(spark: SparkSession, path: str) -> DataFrame:
    """(id, domain, zone) of a registry export: fields by ";", zone at the end of field 1."""
    lines = with_row_number(spark.read.text(path))
    fields = F.split("value", ";")
    zone = F.element_at(F.split(F.get(fields, F.lit(1)), "-"), -1)
    return lines.select("id", F.get(fields, F.lit(0)).alias("domain"), zone.alias("zone"))


def read_inns_csv(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Distinct ``inn`` of a CSV, or of its first ``limit`` rows; leading zeros stay."""
    rows = spark.read.option("header", True).csv(path)
    if limit is not None:
        rows = with_row_number(rows, "_row").where(F.col("_row") < limit)
    return rows.select("inn").distinct()


def read_json_rows(spark: SparkSession, path: str, schema: T.StructType = INN_ROWS) -> DataFrame:
    """Rows of files that each hold a JSON array of objects or one object."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def write_inns_json(inns: DataFrame, path: str) -> None:
    """Write the tax ids that belong to a domain, one JSON object per line."""
    with_domain(inns).write.mode("overwrite").json(path)


def _as_array(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines of one JSON array out of the JSON objects of a partition."""
    yield pd.DataFrame({"value": ["["]})
    comma = ""
    for batch in batches:
        if len(batch):
            lines = "," + batch["value"]
            lines.iloc[0] = comma + batch["value"].iloc[0]
            comma = ","
            yield pd.DataFrame({"value": lines})
    yield pd.DataFrame({"value": ["]"]})


def write_json_arrays(df: DataFrame, path: str) -> None:
    """Write files that each hold one JSON array, the form ``read_json_rows`` reads.

    Every partition is one file, so none should be large: an array is read
    back by a single task.
    """
    objects = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
    objects.mapInPandas(_as_array, "value string").write.mode("overwrite").text(path)
