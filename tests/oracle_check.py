"""Spark-vs-DuckDB comparison in the manner of the driver's gate.

Usage: ``python tests/oracle_check.py [--plain] [sf_dir] [query ...]``
(``--plain``: a bare session instead of ``build_session``). Prints one line
per query: rows on both sides, column-name match, multiset value match.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def rows_multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir, name, fn, sql, con):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return dict(name=name, spark_rows=len(s_rows), oracle=None, secs=round(t1 - t0, 2))
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    same_cols = sorted(s_cols) == sorted(d_cols)
    same_vals = same_cols and rows_multiset(s_cols, s_rows) == rows_multiset(d_cols, d_rows)
    out = dict(name=name, spark_rows=len(s_rows), oracle_rows=len(d_rows), cols=same_cols,
               values=same_vals, secs=round(t1 - t0, 2))
    if not same_cols:
        out["only_spark"] = sorted(set(s_cols) - set(d_cols))
        out["only_oracle"] = sorted(set(d_cols) - set(s_cols))
    elif not same_vals:
        a, b = rows_multiset(s_cols, s_rows), rows_multiset(d_cols, d_rows)
        diff_a, diff_b = list((a - b).items())[:2], list((b - a).items())[:2]
        cols = sorted(s_cols)
        for (ra, _), (rb, _) in zip(diff_a, diff_b):
            out.setdefault("diffs", []).append(
                {c: (x, y) for c, x, y in zip(cols, ra, rb) if x != y})
    return out


def main(argv):
    from touchline.session import build_session
    import __spark_entry__ as E

    plain = "--plain" in argv  # a bare session, as an outside caller would build it
    argv = [a for a in argv if a != "--plain"]
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:]
    if plain:
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
                 .config("spark.ui.enabled", "false").getOrCreate())
    else:
        spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if wanted and name not in wanted:
            continue
        try:
            out = compare(spark, sf_dir, name, fn, oracle.get(name), con)
        except Exception as exc:  # noqa: BLE001 - report and continue
            out = dict(name=name, error=f"{type(exc).__name__}: {str(exc)[:400]}")
        ok = out.get("values", out.get("oracle", 1) is None and "error" not in out)
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(out), flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
