"""Run every registered query on both engines and compare row for row.

usage: python -m checks.compare [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

from checks.oracle import ORACLE
from checks.registry import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    return (type(value).__name__, repr(value))


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, folder: str) -> str:
    """Empty when both results are equal, else what differs."""
    df = QUERIES[name](spark, folder)
    ours = rows_of(df.columns, df.collect())
    if name not in ORACLE:
        return "" if ours else "no rows"
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    theirs = rows_of(columns, result.fetchall())
    if ours == theirs:
        return "" if ours else "both empty"
    only_ours, only_theirs = ours - theirs, theirs - ours
    return (f"{sum(ours.values())} rows against {sum(theirs.values())}, {sum(only_ours.values())} differ; "
            f"columns {sorted(columns)}; ours {list(only_ours)[:2]} theirs {list(only_theirs)[:2]}")


def main() -> None:
    from navrecon.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(folder), 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, folder)
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{len(names) - bad} of {len(names)} equal; without SQL: {sorted(set(names) - set(ORACLE))}")


if __name__ == "__main__":
    main()
