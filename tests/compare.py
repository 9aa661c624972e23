"""Comparing a Spark result with DuckDB's, as bags of rows."""

import collections
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return con


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else float(f"{v:.12g}")
        return v

    return collections.Counter(tuple(value(r[i]) for i in order) for r in rows)


def differences(df, con, sql):
    """Problems found; empty when the results agree."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    expected = cur.fetchall()
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    wanted = {
        "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
        "float": "FLOAT", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
    }
    for name, kind in df.dtypes:
        if wanted.get(kind, kind) != kinds[name]:
            problems.append(f"{name}: {kind} != {kinds[name]}")
    got = [tuple(r) for r in df.collect()]
    a, b = _bag(df.columns, got), _bag(names, expected)
    if a != b:
        problems.append(
            f"{len(got)} rows != {len(expected)}; "
            f"extra {list((a - b).items())[:3]}; missing {list((b - a).items())[:3]}"
        )
    if not got:
        problems.append("no rows")
    return problems
