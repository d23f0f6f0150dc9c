"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0 if value else 0.0)
    return str(value)


_SAME = {"long": "BIGINT", "integer": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN", "date": "DATE"}


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty if names, types and rows agree."""
    found = []
    relation = con.sql(sql)
    types = {c: str(t) for c, t in zip(relation.columns, relation.types, strict=True)}
    for f in spark_df.schema.fields:
        want = _SAME.get(f.dataType.typeName(), f.dataType.typeName())
        if types.get(f.name) != want:
            found.append(f"column {f.name}: {want} against {types.get(f.name)}")
    if set(types) != set(spark_df.columns):
        found.append(f"columns {sorted(spark_df.columns)} against {sorted(types)}")
        return found
    names = sorted(types)
    quoted = ", ".join(f'"{c}"' for c in names)
    theirs = sorted(
        tuple(_cell(v) for v in row)
        for row in con.sql(f"SELECT {quoted} FROM ({sql})").fetchall()
    )
    ours = sorted(tuple(_cell(v) for v in row) for row in spark_df.select(*names).collect())
    if len(ours) != len(theirs):
        found.append(f"{len(ours)} rows against {len(theirs)}")
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    return found
