"""Run registered queries next to their SQL twins and compare all rows."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or isinstance(value, (bool, str, datetime.datetime)):
        return repr(value)
    if isinstance(value, (int, float)):
        return repr(float(value) + 0.0) if not math.isnan(float(value)) else "nan"
    try:
        return repr(float(value))
    except (TypeError, ValueError):
        return repr(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(row[i]) for i in order) for row in rows)


def difference(spark_df, connection, sql: str) -> str | None:
    """None if both sides hold the same rows, else a description of the first difference."""
    mine = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = connection.execute(sql)
    theirs = canonical([d[0] for d in result.description], result.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} against {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} rows against {len(theirs[1])}"
    bad = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def main() -> None:
    import __spark_entry__ as entry
    from weighted_insights.session import local_session

    folder = sys.argv[1]
    chosen = sys.argv[2:]
    spark = local_session()
    connection = connect(folder)
    twins = entry.oracle_sql()
    for name, function in entry.queries().items():
        if chosen and not any(name.startswith(c) for c in chosen):
            continue
        start = time.time()
        try:
            df = function(spark, folder)
            if name in twins:
                outcome = difference(df, connection, twins[name]) or "same"
            else:
                outcome = f"{len(df.collect())} rows"
        except Exception as error:  # report and go on with the next query
            outcome = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28s} {time.time() - start:6.2f}s  {outcome}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
