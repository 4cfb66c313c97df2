"""Compare registered queries with their SQL on the given tables.

``python -m tests.oracle [scale] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if hasattr(value, "tolist") and not isinstance(value, (str, bytes)):
        value = value.tolist()
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def sort_key(row):
    return tuple((v is not None, str(type(v)), v if v is not None else 0) if not isinstance(v, tuple)
                 else (True, "tuple", str(v)) for v in row)


def spark_rows(df):
    names = sorted(df.columns)
    rows = df.select(*[f"`{n}`" for n in names]).collect()
    return names, dict(df.dtypes), sorted((tuple(plain(v) for v in r) for r in rows), key=sort_key)


def duck_rows(con, sql):
    cur = con.execute(sql)
    described = [(d[0], str(d[1])) for d in cur.description]
    order = sorted(range(len(described)), key=lambda i: described[i][0])
    rows = [tuple(plain(r[i]) for i in order) for r in cur.fetchall()]
    return [described[i][0] for i in order], dict(described), sorted(rows, key=sort_key)


TYPE_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
              "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}


def compare(df, con, sql):
    """None when equal, else a short reason."""
    names, types, got = spark_rows(df)
    want_names, want_types, want = duck_rows(con, sql)
    if names != want_names:
        return f"columns {names} != {want_names}"
    bad = {n: (types[n], want_types[n]) for n in names if TYPE_NAMES.get(types[n], types[n]) != want_types[n]}
    if bad:
        return f"types {bad}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    if wrong:
        return f"{len(wrong)} of {len(got)} rows differ, first {wrong[0]} columns {names}"
    return None


def main(argv):
    from hourgrid.session import local_session
    import __spark_entry__ as entry

    sf = f"/root/testdata/sf{argv[0] if argv else '0.01'}"
    spark, con = local_session("oracle"), connect(sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in argv[1:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf)
            if name in oracles:
                result = compare(df, con, oracles[name])
                n = ""
            else:
                result, n = None, f"rows only: {df.count()}"
        except Exception as error:  # report and go on with the next query
            result, n = f"{type(error).__name__}: {str(error)[:700]}", ""
        bad += result is not None
        print(f"{'ok  ' if result is None else 'FAIL'} {name:28s} {time.time() - start:6.2f}s {n} {result or ''}",
              flush=True)
    print(f"{bad} failures")


if __name__ == "__main__":
    main(sys.argv[1:])
