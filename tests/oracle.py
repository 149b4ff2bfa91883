"""Compare a Spark result with its SQL twin as multisets of typed rows."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def spark_rows(df):
    names = sorted(df.columns)
    return names, [tuple(_plain(r[n]) for n in names) for r in df.collect()]


def sql_rows(con, sql: str):
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    names = sorted(columns)
    at = [columns.index(n) for n in names]
    return names, [tuple(_plain(r[i]) for i in at) for r in cursor.fetchall()]


def difference(df, con, sql: str) -> str | None:
    names, got = spark_rows(df)
    wanted_names, wanted = sql_rows(con, sql)
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    got, wanted = sorted(map(repr, got)), sorted(map(repr, wanted))
    if got == wanted:
        return None
    only_got = [r for r in got if r not in set(wanted)][:3]
    only_wanted = [r for r in wanted if r not in set(got)][:3]
    return f"{len(got)} vs {len(wanted)} rows; only spark {only_got}; only sql {only_wanted}"
