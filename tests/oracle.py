"""Compares queries with their SQL: ``python tests/oracle.py [SF_DIR] [NAME...]``."""

from __future__ import annotations

import math
import os
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for name in sorted(os.listdir(folder)):
        path = f"{folder}/{name}"
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def _plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else float(f"{x:.9g}")
    if isinstance(x, (list, tuple)):
        return tuple(map(_plain, x))
    return x


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, folder, name, query, sql) -> str:
    got = query(spark, folder)
    a = rows_of(got.columns, [tuple(r) for r in got.collect()])
    cur = con.execute(sql)
    b = rows_of([c[0] for c in cur.description], cur.fetchall())
    if a[0] != b[0]:
        return f"columns {a[0]} / {b[0]}"
    if a[1] != b[1]:
        x = [r for r in a[1] if r not in set(b[1])][:3] if len(a[1]) < 200_000 else []
        y = [r for r in b[1] if r not in set(a[1])][:3] if len(a[1]) < 200_000 else []
        return f"rows {len(a[1])} / {len(b[1])}; only here {x}; only in SQL {y}"
    return ""


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con, qs, sql = connect(folder), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or [q for q in qs if not q.startswith("p")] + [q for q in qs if q.startswith("p") and q in sql]:
        try:
            if name in sql:
                said = compare(spark, con, folder, name, qs[name], sql[name]) or "same"
            else:
                said = f"{qs[name](spark, folder).count()} rows, no SQL"
        except Exception as e:
            said = f"ERROR {str(e)[:700]}"
        bad += said != "same" and "no SQL" not in said
        print(name, said, flush=True)
    sys.exit(bool(bad))
