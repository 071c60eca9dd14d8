"""Run named queries next to their SQL twins and compare rows as multisets.

    python tests/oracle.py [data folder] [name prefix ...]
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, (str, int)):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else (value + 0.0)
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def kind(value):
    return "n" if isinstance(value, (int, float)) and not isinstance(value, bool) else type(value).__name__


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(repr(plain(r[i])) for i in order) for r in rows))


def compare(spark_df, con, sql):
    """None when equal, else what differs."""
    got_cols, got = table(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want_cols, want = table(names, cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}: only spark {[r for r in got if r not in set(want)][:2]} only sql {[r for r in want if r not in set(got)][:2]}"
    if got != want:
        a, b = set(got), set(want)
        return f"values: only spark {sorted(a - b)[:3]} only sql {sorted(b - a)[:3]} ({len(a - b)} rows)"
    return None


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from leadspark.session import build_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    prefixes = tuple(argv[1:])
    import tempfile

    spark = build_session("oracle", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="spark-")})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = []
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name, fn in queries.items():
        if prefixes and not name.startswith(prefixes):
            continue
        started = time.time()
        try:
            df = fn(spark, folder)
            if name in oracles:
                problem = compare(df, con, oracles[name])
                tag = "ok" if problem is None else "DIFF"
            else:
                problem, tag = None, f"rows={len(df.collect())}"
        except Exception as error:  # report and go on
            problem, tag = f"{type(error).__name__}: {str(error)[:600]}", "ERROR"
        if problem:
            bad.append(name)
        print(f"{name:32s} {tag} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{len(bad)} bad: {bad}")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
