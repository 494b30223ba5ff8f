"""Run registered queries next to their SQL and report differences.

    python tests/check_oracle.py [sf_dir] [name ...]
"""

import math
import os
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, float):
        return f"{v:.6f}"
    return str(v)


def compare(df, con, sql):
    """None when equal, else a short description."""
    spark_rows = df.collect()
    cur = con.execute(sql)
    names, rows = [d[0] for d in cur.description], cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    order = sorted(names)
    left = sorted(tuple(cell(r[c]) for c in order) for r in spark_rows)
    right = sorted(tuple(cell(r[names.index(c)]) for c in order) for r in rows)
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    types = {d[0]: str(d[1]) for d in cur.description}
    odd = [f"{c}:{t}/{types[c]}" for c, t in df.dtypes if kinds.get(t) and kinds[t] not in types[c].upper().replace("STRING", "VARCHAR").replace("NUMBER", "BIGINT INTEGER DOUBLE").replace("BOOL", "BOOLEAN")]
    if len(left) != len(right):
        only = set(left) ^ set(right)
        return f"rows {len(left)} vs {len(right)}; e.g. {list(only)[:2]}"
    diff = [(a, b) for a, b in zip(left, right) if a != b]
    if diff:
        return f"{len(diff)} of {len(left)} differ; e.g. {diff[0]}"
    return f"types {odd}" if odd else None


if __name__ == "__main__":
    import __spark_entry__ as entry_module
    from lectern.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(folder), entry_module.oracle_sql()
    bad = 0
    for name, run in entry_module.queries().items():
        if wanted and name not in wanted:
            continue
        t = time.time()
        try:
            df = run(spark, folder)
            if name not in sqls:
                print(f"rows {df.count():>7} {time.time() - t:6.2f}s {name} (no SQL)", flush=True)
                continue
            trouble = compare(df, con, sqls[name])
            rows = con.execute(f"SELECT count(*) FROM ({sqls[name]})").fetchone()[0]
        except Exception as e:
            trouble, rows = f"{type(e).__name__}: {str(e)[:600]}", -1
        bad += trouble is not None
        print(f"{'BAD ' if trouble else 'ok  '} {rows:>7} {time.time() - t:6.2f}s {name} {trouble or ''}", flush=True)
    print("bad:", bad)
