"""Run registered queries beside their SQL and compare rows. Also a small command:

python tests/compare.py SF_DIR [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value: object) -> object:
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    rows = df.select(*names).collect()
    return names, Counter(tuple(_plain(v) for v in row) for row in rows)


def duck_rows(con, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = result.fetchall()
    counted = Counter(tuple(_plain(row[i]) for i in order) for row in rows)
    return [names[i] for i in order], counted


def difference(spark, con, sf_dir: str, query, sql: str) -> tuple[str | None, int]:
    """A text that tells what differs, or None; and the number of rows."""
    names, got = spark_rows(query(spark, sf_dir))
    wanted_names, wanted = duck_rows(con, sql)
    if names != wanted_names:
        return f"columns {names} instead of {wanted_names}", 0
    if got != wanted:
        extra, missing = got - wanted, wanted - got
        return (
            f"{sum(got.values())} rows, {sum(wanted.values())} expected; "
            f"extra {list(extra)[:2]}, missing {list(missing)[:2]}"
        ), 0
    return None, sum(got.values())


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir, *chosen = sys.argv[1:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    queries, sqls = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in chosen or queries:
        began = time.time()
        try:
            if name in sqls:
                problem, rows = difference(spark, con, sf_dir, queries[name], sqls[name])
            else:
                problem, rows = None, queries[name](spark, sf_dir).count()
        except Exception as error:  # noqa: BLE001
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", 0
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {rows} {time.time() - began:.1f}s", flush=True)
        if problem:
            print("     ", problem[:1500], flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
