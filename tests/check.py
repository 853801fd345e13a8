"""Compare registered queries with their SQL: python tests/check.py [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def normal(rows, names):
    """Rows as a sorted list of texts, columns by name."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


_DUCK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}


def compare(spark, con, name, query, sql, sf_dir):
    """None when the query equals its SQL, else what differs."""
    df = query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    types = {n: _DUCK_TYPES.get(str(d[1]), str(d[1])) for n, d in zip(names, result.description)}
    if types != dict(df.dtypes):
        return f"types {[(n, t, dict(df.dtypes)[n]) for n, t in types.items() if dict(df.dtypes)[n] != t]}"
    got, want = normal(rows, df.columns), normal(expected, names)
    if got != want:
        extra = [g for g in got if g not in set(want)][:2]
        lost = [w for w in want if w not in set(got)][:2]
        return f"{len(got)} rows, expected {len(want)}; extra {extra}; lost {lost}"
    return None


def session(cores=8):
    import atexit
    import shutil
    import tempfile

    from pyspark.sql import SparkSession

    folder = tempfile.mkdtemp(prefix="folioscan-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", folder)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con, sqls = session(), duck(sf_dir), oracle_sql()
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, name, query, sqls[name], sf_dir)
                verdict = "ok" if problem is None else f"DIFF {problem}"
            else:
                verdict = f"rows only: {query(spark, sf_dir).count()}"
        except Exception as e:
            verdict = f"FAIL {type(e).__name__}: {str(e)[:600]}"
        print(f"{name:28s} {time.time() - start:6.2f}s {verdict[:1500]}", flush=True)
    spark.stop()
