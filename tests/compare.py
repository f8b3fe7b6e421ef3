"""Compare a Spark result with the oracle's: columns, types, row count and values, order ignored."""

from __future__ import annotations

import os
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]
SPARK_TO_ORACLE = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                   "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "float": "FLOAT"}


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def differences(df, con, sql: str) -> str | None:
    """None when equal, else a description."""
    cursor = con.execute(sql)
    names = [column[0] for column in cursor.description]
    kinds = {column[0]: str(column[1]) for column in cursor.description}
    expected = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    for name, dtype in df.dtypes:
        if SPARK_TO_ORACLE.get(dtype, dtype) != kinds[name]:
            return f"type of {name}: {dtype} != {kinds[name]}"
    order = sorted(names)
    positions = [names.index(name) for name in order]
    want = Counter(tuple(row[i] for i in positions) for row in expected)
    got = Counter(tuple(row[name] for name in order) for row in df.collect())
    if want == got:
        return None
    missing, extra = list((want - got).elements()), list((got - want).elements())
    return (f"rows {sum(got.values())} vs {sum(want.values())}; {len(missing)} missing, {len(extra)} extra; "
            f"columns {order}\n first missing {missing[:3]}\n first extra {extra[:3]}")
