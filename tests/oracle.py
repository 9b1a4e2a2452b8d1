"""Run registered queries and their SQL side by side.

Usage: python tests/oracle.py [sf_dir] [name ...]
"""

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET threads = 4")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return f"{type(value).__name__}:{value}"


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


SPARK_KINDS = {"long": "BIGINT", "integer": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE"}


def compare(spark, con, query, sql, sf_dir):
    """(problem or None, number of rows, seconds)."""
    started = time.time()
    df = query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    seconds = time.time() - started
    result = con.execute(sql)
    kinds = {d[0]: str(d[1]) for d in result.description}
    want = canonical([d[0] for d in result.description], result.fetchall())
    got = canonical(df.columns, rows)
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}", len(rows), seconds
    mine = {f.name: SPARK_KINDS.get(f.dataType.typeName(), f.dataType.typeName()) for f in df.schema.fields}
    if mine != kinds:
        return f"types {mine} != {kinds}", len(rows), seconds
    if got[1] != want[1]:
        extra = [r for r in got[1] if r not in set(want[1])][:2]
        missing = [r for r in want[1] if r not in set(got[1])][:2]
        return f"{len(got[1])} rows != {len(want[1])}; only ours {str(extra)[:900]}; only SQL {str(missing)[:900]}", len(rows), seconds
    return None, len(rows), seconds


def main():
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        try:
            problem, n, seconds = compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], sf_dir)
        except Exception as error:
            problem, n, seconds = f"{type(error).__name__}: {str(error)[:700]}", -1, 0.0
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} rows={n} {seconds:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
