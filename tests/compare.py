"""Compare a registered query with its SQL twin; also runnable as a script."""

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _key(value):
    return (value is None, str(type(value).__name__), str(value))


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=lambda r: [_key(v) for v in r])


def _same(a, b):
    return type(a) is type(b) and a == b


def compare(spark, con, folder, query, sql):
    """None when both agree on columns, types and every value, else what differs."""
    frame = query(spark, folder)
    left = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    right = _rows(columns, result.fetchall())
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}"
    for a, b in zip(left, right):
        if not all(_same(x, y) for x, y in zip(a, b)):
            return f"{sorted(columns)}: {a} != {b}"[:3000]
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    folder = sys.argv[1]
    names = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in names:
        start = time.time()
        try:
            if name in oracles:
                verdict = compare(spark, con, folder, queries[name], oracles[name]) or "ok"
            else:
                verdict = f"rows {queries[name](spark, folder).count()}"
        except Exception as error:
            verdict = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:26s} {time.time() - start:6.2f}s {verdict}", flush=True)
