"""Order-free comparison of a Spark result with DuckDB's."""

from __future__ import annotations

import os

import duckdb

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def sorted_rows(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is not None, str(v)) for v in r])


def spark_rows(df) -> list[tuple]:
    return sorted_rows(df.select(*sorted(df.columns)).collect())


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    columns = sorted(c[0] for c in con.execute(f"DESCRIBE ({sql})").fetchall())
    chosen = ", ".join(f'"{c}"' for c in columns)
    return columns, sorted_rows(con.execute(f"SELECT {chosen} FROM ({sql})").fetchall())
