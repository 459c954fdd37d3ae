"""Run a registered query and its SQL twin and compare names, types and every value."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
KINDS = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(row):
    return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row)


def differences(df, con, sql: str) -> list[str]:
    """Empty when equal; otherwise what differs (doubles must be equal to the last bit shown)."""
    rel = con.sql(sql)
    names, kinds = list(rel.columns), [str(t) for t in rel.types]
    out = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} vs {sorted(names)}"]
    ours = dict(df.dtypes)
    for n, k in zip(names, kinds):
        if KINDS.get(ours[n]) != k:
            out.append(f"type of {n}: {ours[n]} vs {k}")
    order = sorted(names)
    got = sorted((tuple(r[n] for n in order) for r in df.collect()), key=_key)
    picked = con.sql(f"SELECT {', '.join(chr(34) + n + chr(34) for n in order)} FROM ({sql})") if not sql.lstrip().startswith("WITH") else rel.select(*[duckdb.ColumnExpression(n) for n in order])
    want = sorted(picked.fetchall(), key=_key)
    if len(got) != len(want):
        out.append(f"rows {len(got)} vs {len(want)}")
        return out
    bad = 0
    for a, b in zip(got, want):
        for n, x, y in zip(order, a, b):
            same = x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y))
            if not same:
                bad += 1
                if bad <= 5:
                    out.append(f"{n}: {x!r} vs {y!r} in {a} / {b}")
    if bad:
        out.append(f"{bad} cells differ in {len(got)} rows")
    return out
