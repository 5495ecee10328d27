"""Run registered queries in Spark and DuckDB and compare their rows.

    python tests/compare.py <sf_dir> [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = """region nation customer supplier part orders lineitem events
documents embeddings pages benchmark labels conversations""".split()


def oracle_connection(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def oracle_rows(connection, sql: str) -> list[tuple]:
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = [tuple(row[i] for i in order) for row in result.fetchall()]
    return sorted(names), sorted(rows, key=repr)


def spark_rows(df) -> list[tuple]:
    names = sorted(df.columns)
    return names, sorted((tuple(row) for row in df.select(names).collect()), key=repr)


def difference(expected, actual) -> str | None:
    if expected[0] != actual[0]:
        return f"columns {expected[0]} != {actual[0]}"
    if len(expected[1]) != len(actual[1]):
        return f"{len(expected[1])} rows expected, {len(actual[1])} found"
    for one, other in zip(expected[1], actual[1]):
        if one != other:
            return f"expected {str(one)[:300]}\n     found {str(other)[:300]}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as contract
    from termfold.session import local_session

    sf_dir, *chosen = sys.argv[1:]
    spark = local_session(8)
    connection = oracle_connection(sf_dir)
    sql = contract.oracle_sql()
    queries = contract.queries()
    print("without SQL:", sorted(set(queries) - set(sql)), "without query:", sorted(set(sql) - set(queries)))
    failed = []
    for name in chosen or queries:
        start = time.time()
        try:
            actual = spark_rows(queries[name](spark, sf_dir))
            middle = time.time()
            problem = difference(oracle_rows(connection, sql[name]), actual)
            print(f"{name:30} {'ok' if not problem else problem} rows={len(actual[1])} "
                  f"spark={middle - start:.1f}s duckdb={time.time() - middle:.1f}s", flush=True)
        except Exception as error:
            problem = str(error)[:1500]
            print(f"{name:30} ERROR {problem}", flush=True)
        if problem:
            failed.append(name)
    print("failed:", failed)
