"""Run registered queries in Spark and their oracle SQL in DuckDB, compare
column names, types, row counts and order-insensitive values.

    python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pyarrow as pa  # noqa: E402

from tokoledger.sources.standins import BASE_TABLES  # noqa: E402


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    for t in (*BASE_TABLES, "customer", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return format(v, "f")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _type_name(t: pa.DataType) -> str:
    if pa.types.is_large_string(t) or pa.types.is_string(t):
        return "string"
    if pa.types.is_timestamp(t):
        return "timestamp"
    return str(t)


def table_rows(tbl: pa.Table):
    cols = sorted(tbl.column_names)
    data = [tbl.column(c).to_pylist() for c in cols]
    rows = sorted((tuple(_norm(v) for v in r) for r in zip(*data)), key=repr)
    return cols, rows


def digest(rows) -> str:
    h = hashlib.sha256()
    for r in rows:
        h.update(repr(r).encode())
    return h.hexdigest()[:16]


def compare(spark, name: str, build, sql: str | None, sf_dir: str, con) -> dict:
    t0 = time.time()
    s_tbl = build(spark, sf_dir).toArrow()
    t_spark = time.time() - t0
    res = {"query": name, "spark_rows": s_tbl.num_rows, "spark_sec": round(t_spark, 2)}
    if sql is None:
        res["status"] = "no-oracle"
        return res
    t0 = time.time()
    d_tbl = con.sql(sql).to_arrow_table()
    if hasattr(d_tbl, "read_all"):
        d_tbl = d_tbl.read_all()
    res["duck_sec"] = round(time.time() - t0, 2)
    res["duck_rows"] = d_tbl.num_rows
    s_names, d_names = sorted(s_tbl.column_names), sorted(d_tbl.column_names)
    problems = []
    if s_names != d_names:
        problems.append(f"columns spark-only={sorted(set(s_names) - set(d_names))} "
                        f"duck-only={sorted(set(d_names) - set(s_names))}")
    else:
        for c in s_names:
            st, dt_ = _type_name(s_tbl.schema.field(c).type), _type_name(d_tbl.schema.field(c).type)
            if st != dt_:
                problems.append(f"type {c}: spark={st} duck={dt_}")
        if s_tbl.num_rows != d_tbl.num_rows:
            problems.append("row count")
        _, s_rows = table_rows(s_tbl)
        _, d_rows = table_rows(d_tbl)
        if digest(s_rows) != digest(d_rows):
            s_set, d_set = set(s_rows), set(d_rows)
            only_s = [r for r in s_rows if r not in d_set][:3]
            only_d = [r for r in d_rows if r not in s_set][:3]
            problems.append(f"values differ; cols={s_names}\n  spark-only {only_s}\n  duck-only  {only_d}")
    res["status"] = "ok" if not problems else "FAIL"
    res["problems"] = problems
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:]
    import __spark_entry__ as E
    from tokoledger.session import local_session

    spark = local_session()
    con = duck_connection(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, build in qs.items():
        if wanted and name not in wanted:
            continue
        try:
            r = compare(spark, name, build, sqls.get(name), sf_dir, con)
        except Exception as e:  # report and go on
            r = {"query": name, "status": "ERROR", "problems": [f"{type(e).__name__}: {str(e)[:800]}"]}
        bad += r["status"] in ("FAIL", "ERROR")
        print(f"{r['status']:9s} {name:34s} rows={r.get('spark_rows')}/{r.get('duck_rows')} "
              f"spark={r.get('spark_sec')}s duck={r.get('duck_sec')}s")
        for p in r.get("problems", []):
            print("    ", p)
    print("FAILED:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
