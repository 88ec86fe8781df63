"""Run registered queries and their SQL twins and compare all rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def cell(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if hasattr(value, "isoformat"):
        return value.isoformat(" ") if hasattr(value, "hour") else value.isoformat()
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(cell(r[i])) for i in order) for r in data)


def difference(spark, sf_dir, db, build, sql) -> str | None:
    """None if both sides agree, else a short description."""
    df = build(spark, sf_dir)
    ours = [tuple(r) for r in df.collect()]
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = rows(df.columns, ours), rows(names, theirs)
    if a == b:
        return None
    only_a, only_b = [x for x in a if x not in set(b)][:3], [x for x in b if x not in set(a)][:3]
    return f"{len(a)} rows against {len(b)}; {sorted(df.columns)}; ours only {only_a}; theirs only {only_b}"
