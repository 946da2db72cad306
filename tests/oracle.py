"""Compare a registered Spark query with its DuckDB twin on one scale factor.

Usage: ``python -m tests.oracle /root/testdata/sf0.01 [name ...]``
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return f"D{v}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return f"{type(v).__name__}:{v}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


# Spark simpleString -> DuckDB type name, for the schema part of the comparison.
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE",
                 "smallint": "SMALLINT", "tinyint": "TINYINT"}


def type_mismatches(spark_schema, duck_types: dict) -> list[str]:
    out = []
    for f in spark_schema.fields:
        st = f.dataType.simpleString()
        want = SPARK_TO_DUCK.get(st, st.upper())
        if duck_types.get(f.name) != want:
            out.append(f"{f.name}: spark={st} duck={duck_types.get(f.name)}")
    return out


def compare(spark, con, name: str, sf_dir: str, fn, sql: str | None):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return {"name": name, "ok": None, "rows": len(s_rows), "spark_s": round(t1 - t0, 2)}
    rel = con.sql(sql)
    d_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {"name": name, "rows": len(s_rows), "oracle_rows": len(d_rows), "spark_s": round(t1 - t0, 2)}
    if sorted(s_cols) != sorted(d_cols):
        out.update(ok=False, why=f"columns differ: spark={s_cols} duck={d_cols}")
        return out
    bad_types = type_mismatches(sdf.schema, d_types)
    if bad_types:
        out.update(ok=False, why=f"types differ: {bad_types}")
        return out
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a != b:
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        out.update(ok=False, why=f"values differ; spark-only={diff_a} duck-only={diff_b}",
                   cols=sorted(s_cols))
        return out
    out["ok"] = True
    return out


def main(argv):
    sys.path.insert(0, ".")
    from wellspark.session import local_session
    import __spark_entry__ as E

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(E.queries())
    spark = local_session(8)
    con = duck(sf_dir)
    qs, twins = E.queries(), E.oracle_sql()
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, sf_dir, qs[n], twins.get(n))
        except Exception as exc:  # report and continue
            r = {"name": n, "ok": False, "why": f"{type(exc).__name__}: {str(exc)[:400]}"}
        bad += r.get("ok") is False
        print(r, flush=True)
    print(f"{len(names)} queries, {bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
