"""Readers and writers."""

from .files import (
    read_domains_csv,
    read_domains_txt,
    read_inns_csv,
    read_json_rows,
    with_row_number,
    write_inns_json,
    write_json_arrays,
)
from .partitions import PartitionedTable
from .tables import append_records, latest_snapshot, read_table, seed_lookup, write_table

__all__ = [
    "PartitionedTable",
    "append_records", "latest_snapshot", "read_domains_csv", "read_domains_txt", "read_inns_csv",
    "read_json_rows", "read_table", "seed_lookup", "with_row_number", "write_inns_json", "write_json_arrays",
    "write_table",
]
