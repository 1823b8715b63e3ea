"""Compare catalog queries with their SQL in DuckDB: columns, types and all values."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd

TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    cells = [[None if pd.isna(v) else v for v in frame[c].tolist()] for c in frame.columns]
    return sorted(zip(*cells), key=repr)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    found = []
    relation = con.sql(sql)
    want = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    have = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
            for f in df.schema}
    if want != have:
        found.append(f"schema: spark {sorted(have.items())} sql {sorted(want.items())}")
        return found
    mine, theirs = rows(df.toPandas()), rows(relation.df())
    if len(mine) != len(theirs):
        found.append(f"rows: spark {len(mine)} sql {len(theirs)}")
    if mine != theirs:
        ours, others = set(mine), set(theirs)
        extra = [r for r in mine if r not in others][:2]
        missing = [r for r in theirs if r not in ours][:2]
        found.append(f"values: only spark {extra} only sql {missing}")
    if not mine:
        found.append("no rows")
    return found
