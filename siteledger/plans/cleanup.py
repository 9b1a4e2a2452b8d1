"""Re-check stored sites and drop junk."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators.audit import audit_deleted
from ..operators.classify import clean_domain_info
from ..operators.rules import Rule


def clean_up(info: DataFrame, rules: Sequence[Rule] | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept rows, audit records of the deleted ones)."""
    kept, deleted = clean_domain_info(info, rules)
    return kept, audit_deleted(deleted)
