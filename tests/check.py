"""Compare registered queries with their SQL at a small scale: python tests/check.py [names...]"""

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v)


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows)


def differences(spark, con, folder: str, name: str, run, sql: str) -> str | None:
    frame = run(spark, folder)
    mine = [tuple(r) for r in frame.collect()]
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    theirs = result.fetchall()
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(frame.columns)} / {sorted(columns)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} / {len(theirs)}"
    a, b = canonical(frame.columns, mine), canonical(columns, theirs)
    for x, y in zip(a, b):
        if x != y:
            return f"{sorted(columns)}\n   spark {str(x)[:600]}\n   sql   {str(y)[:600]}"
    return None if mine else "no rows"


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    wanted = [n for n in queries if not sys.argv[1:] or any(w in n for w in sys.argv[1:])]
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            if name in oracles:
                problem = differences(spark, con, folder, name, queries[name], oracles[name])
            else:
                rows = len(queries[name](spark, folder).collect())
                problem = None if rows else "no rows"
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        kind = "sql" if name in oracles else "rows"
        print(f"{'ok ' if problem is None else 'BAD'} {kind:4} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(wanted)} queries, {bad} bad")
