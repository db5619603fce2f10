"""Run registered queries next to their SQL in DuckDB and compare every value.

    python tests/parity.py [--sf /root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(0.0 if v == 0 else v)
    return repr(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, text: str) -> tuple[bool, str]:
    got_columns = df.columns
    got = rows_of(got_columns, df.collect())
    cursor = con.execute(text)
    want_columns = [c[0] for c in cursor.description]
    types = {c[0]: str(c[1]) for c in cursor.description}
    want = rows_of(want_columns, cursor.fetchall())
    if sorted(got_columns) != sorted(want_columns):
        return False, f"columns {sorted(set(got_columns) ^ set(want_columns))}"
    kinds = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for name, kind in df.dtypes:
        if kinds.get(kind) != types[name]:
            return False, f"type of {name}: {kind} / {types[name]}"
    if len(got) != len(want):
        return False, f"rows {len(got)} / {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return False, f"{len(bad)} of {len(got)} rows differ, e.g.\n   {bad[0][0]}\n   {bad[0][1]}"
    return True, f"{len(got)} rows"


def main() -> int:
    import __spark_entry__ as entry
    from weirflow.lineage import drop_work_folders
    from weirflow.session import build_session

    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if "--sf" in args:
        at = args.index("--sf")
        sf_dir = args[at + 1]
        del args[at : at + 2]
    spark = build_session("parity", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, fn in queries.items():
        if args and not any(name == a or (a.endswith("*") and name.startswith(a[:-1])) for a in args):
            continue
        begin = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracle:
                ok, note = compare(df, con, oracle[name])
            else:
                ok, note = True, f"{df.count()} rows, no SQL"
        except Exception as e:  # a broken query must not hide the others
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        drop_work_folders(spark)
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:32s} {time.time() - begin:6.1f}s  {note}", flush=True)
    print(f"{failed} failed")
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
