"""Run registered queries in Spark and DuckDB and compare the rows.

    python -m wakeline_checks.compare /root/testdata/sf0.01 [key-prefix ...]
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from wakeline.session import STATIC_CONF

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def local_session() -> SparkSession:
    builder = SparkSession.builder
    for key, value in STATIC_CONF.items():
        builder = builder.config(key, value)
    return (
        builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .appName("wakeline-checks")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _row_key(names, row) -> tuple:
    return tuple(repr(row[names.index(n)]) for n in sorted(names))


def difference(df, connection, statement: str) -> str | None:
    """What differs between a Spark result and a DuckDB statement, or None."""
    names = df.columns
    spark_rows = Counter(_row_key(names, tuple(r)) for r in df.collect())
    result = connection.execute(statement)
    duck_names = [d[0] for d in result.description]
    if sorted(duck_names) != sorted(names):
        return f"columns {sorted(names)} against {sorted(duck_names)}"
    duck_rows = Counter(_row_key(duck_names, r) for r in result.fetchall())
    if spark_rows == duck_rows:
        return None
    only_spark, only_duck = spark_rows - duck_rows, duck_rows - spark_rows
    return (
        f"{sum(spark_rows.values())} against {sum(duck_rows.values())} rows;"
        f" only Spark {sum(only_spark.values())}: {list(only_spark)[:2]};"
        f" only DuckDB {sum(only_duck.values())}: {list(only_duck)[:2]}"
    )


def main(argv: list[str]) -> int:
    from wakeline_checks import ORACLES, QUERIES

    sf_dir, prefixes = argv[0], tuple(argv[1:])
    spark, connection = local_session(), connect(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for key, function in QUERIES.items():
        if prefixes and not key.startswith(prefixes):
            continue
        started = time.time()
        try:
            df = function(spark, sf_dir)
            if key in ORACLES:
                problem = difference(df, connection, ORACLES[key])
                verdict = "ok" if problem is None else f"DIFFERENT {problem}"
            else:
                problem, verdict = None, f"rows only: {df.count()}"
        except Exception as error:
            problem = verdict = f"ERROR {str(error)[:600]}"
        failed += problem is not None
        print(f"{key:36s} {time.time() - started:6.2f}s {verdict}", flush=True)
    print(f"{failed} of {len(QUERIES)} failed" if failed else "all agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
