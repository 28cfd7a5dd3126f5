"""Run a registered query on Spark and its check statement on DuckDB, and compare the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    if v is None:
        return "\0"
    if isinstance(v, bool):
        return f"bool:{v}"
    if isinstance(v, (int,)):
        return f"int:{v}"
    if isinstance(v, decimal.Decimal):
        return f"dec:{v}"
    if isinstance(v, float):
        return f"float:{v!r}" if not math.isnan(v) else "nan"
    if isinstance(v, dt.datetime):
        return f"ts:{v.isoformat()}"
    if isinstance(v, dt.date):
        return f"date:{v.isoformat()}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_value(x) for x in v) + "]"
    return f"str:{v}"


def _type(name: str) -> str:
    name = str(name).lower()
    for a, b in (("bigint", "int64"), ("integer", "int32"), ("varchar", "string"), ("timestamp_ntz", "timestamp"), ("boolean", "bool")):
        name = name.replace(a, b)
    if name == "int":
        return "int32"
    if name == "array<string>":
        return "string[]"
    if name == "json":
        return "string"
    return name


def compare(spark_df, con, sql: str) -> list[str]:
    """The differences between both results; empty when they agree."""
    relation = con.sql(sql)
    expected_types = dict(zip(relation.columns, map(_type, relation.types)))
    got_types = {n: _type(t) for n, t in spark_df.dtypes}
    problems = []
    if set(expected_types) != set(got_types):
        return [f"columns differ: spark {sorted(got_types)} check {sorted(expected_types)}"]
    for n in sorted(got_types):
        if got_types[n] != expected_types[n]:
            problems.append(f"type of {n}: spark {got_types[n]} check {expected_types[n]}")
    order = sorted(got_types)
    want = sorted(tuple(_value(r[relation.columns.index(n)]) for n in order) for r in relation.fetchall())
    got = sorted(tuple(_value(r[n]) for n in order) for r in spark_df.collect())
    if len(want) != len(got):
        problems.append(f"rows: spark {len(got)} check {len(want)}")
    if want != got:
        only_got = [g for g in got if g not in set(want)][:2]
        only_want = [x for x in want if x not in set(got)][:2]
        problems.append(f"values over {order}\n   only spark: {only_got}\n   only check: {only_want}")
    return problems
