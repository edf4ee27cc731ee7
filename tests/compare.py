"""Runs a registered query in Spark and its SQL in DuckDB and compares the rows as sets of tuples."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return str(v)
    if hasattr(v, "as_tuple"):
        v = float(v)
    if isinstance(v, float):
        return 0.0 if v == 0 else v
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir: str, build, sql: str) -> str:
    """Empty when both agree, else what differs."""
    df = build(spark, sf_dir)
    names, ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    con = duck(sf_dir)
    relation = con.sql(sql)
    other_names, theirs = rows_of(relation.columns, relation.fetchall())
    if names != other_names:
        return f"columns {names} / {other_names}"
    kinds = {n: KINDS.get(t, t) for n, t in df.dtypes}
    other_kinds = {n: str(t) for n, t in zip(relation.columns, relation.types)}
    if kinds != other_kinds:
        return f"types { {n: (kinds[n], other_kinds[n]) for n in kinds if kinds[n] != other_kinds[n]} }"
    if ours != theirs:
        return (f"rows {sum(ours.values())} / {sum(theirs.values())}; only ours {list((ours - theirs).items())[:3]}; "
                f"only theirs {list((theirs - ours).items())[:3]}; {kinds}")
    return "" if ours else "no rows on either side"
