"""Registry documents to company tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.registry import read_documents, registry_tables
from ..operators.sizing import staged
from ..operators.upsert import upsert
from ..schemas import UNIQUE_KEYS


def load_registry(tables: dict[str, DataFrame], docs: DataFrame) -> dict[str, DataFrame]:
    """Parse every document once and upsert the company tables; adds ``rejects``.

    Later documents (``seq``, if given) and later entries of a document win.
    Without ``seq`` the greater row wins among documents of one company, so a
    rerun gives the same tables.
    """
    found = registry_tables(staged(read_documents(docs)), order=True)
    out = {"rejects": found.pop("rejects")}
    for name, rows in found.items():
        (keys,) = UNIQUE_KEYS[name]
        columns = [c for c in rows.columns if c not in (*keys, "seq")]
        out[name] = upsert(tables[name], rows, keys, columns, "seq")
    return out
