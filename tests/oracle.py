"""Spark-vs-DuckDB comparison in the driver's style: row count, column names,
and an order-insensitive hash of the values."""

from __future__ import annotations

import datetime
import decimal
import hashlib

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    body = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return cols, len(body), hashlib.sha256("\n".join(body).encode()).hexdigest()


_SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
                  "boolean": "BOOLEAN", "smallint": "SMALLINT", "float": "FLOAT", "date": "DATE"}


def types(spark_df, rel):
    """Column -> (Spark type as DuckDB name, DuckDB type) where they differ."""
    s = {f.name: _SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
         for f in spark_df.schema.fields}
    d = dict(zip(rel.columns, (str(t) for t in rel.types)))
    return {c: (s.get(c), d.get(c)) for c in set(s) | set(d) if s.get(c) != d.get(c)}


def compare(spark_df, con, sql):
    s_rows = [tuple(r) for r in spark_df.collect()]
    s = canon(spark_df.columns, s_rows)
    rel = con.sql(sql)
    d = canon(rel.columns, rel.fetchall())
    return s, d


def type_diff(spark_df, con, sql):
    return types(spark_df, con.sql(sql))


if __name__ == "__main__":
    import sys
    import time

    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from stintwise.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = local_session(cores=8, shuffle_partitions=8, driver_memory="8g")
    con = duck(sf)
    qs, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sorted(qs):
        if only and name not in only:
            continue
        t0 = time.time()
        df = qs[name](spark, sf)
        if name in oracle:
            s, d = compare(df, con, oracle[name])
            td = type_diff(df, con, oracle[name])
            if td:
                print(f"{name:40s} TYPE DIFF {td}")
            ok = s == d and not td
            bad += not ok
            print(f"{name:40s} rows={s[1]:8d} oracle={d[1]:8d} {'OK' if ok else 'MISMATCH ' + str(s[0]) + str(d[0])} {time.time() - t0:.1f}s", flush=True)
        else:
            print(f"{name:40s} rows={df.count():8d} (rows only) {time.time() - t0:.1f}s", flush=True)
    print("mismatches:", bad)
