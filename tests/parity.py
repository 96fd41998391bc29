"""Compare registered queries with their reference SQL on one data folder.

Usage: python -m tests.parity [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def normal(value):
    if isinstance(value, float):
        return repr(value)
    return "" if value is None else str(value)


# Column types as both engines name them.
SAME = {
    "LongType": "BIGINT",
    "IntegerType": "INTEGER",
    "DoubleType": "DOUBLE",
    "StringType": "VARCHAR",
    "BooleanType": "BOOLEAN",
    "DateType": "DATE",
    "TimestampNTZType": "TIMESTAMP",
}


def compare(df, con, sql: str) -> list[str]:
    """Differences between a Spark result and the SQL result; empty when they agree."""
    names = sorted(df.columns)
    expected = con.sql(sql)
    problems = []
    if sorted(expected.columns) != names:
        return [f"columns {names} != {sorted(expected.columns)}"]
    kinds = dict(zip(expected.columns, map(str, expected.types)))
    for field in df.schema.fields:
        kind = SAME.get(type(field.dataType).__name__, str(field.dataType))
        if kinds[field.name] != kind:
            problems.append(f"type of {field.name}: {kind} != {kinds[field.name]}")
    quoted = ", ".join(f'"{n}"' for n in names)
    left = sorted(tuple(normal(v) for v in row) for row in df.select(*names).collect())
    right = sorted(
        tuple(normal(v) for v in row)
        for row in con.execute(f"SELECT {quoted} FROM ({sql}) AS q").fetchall()
    )
    if len(left) != len(right):
        problems.append(f"rows {len(left)} != {len(right)}")
    if left != right:
        only_left = sorted(set(left) - set(right))[:2]
        only_right = sorted(set(right) - set(left))[:2]
        problems.append(f"values: spark {only_left} sql {only_right}")
    return problems


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracle = entry.oracle_sql()
    failed = 0
    for name, run in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracle:
                problems = compare(df, con, oracle[name])
                rows = con.execute(f"SELECT COUNT(*) FROM ({oracle[name]}) AS q").fetchone()[0]
            else:
                problems, rows = [], df.count()
        except Exception as error:  # noqa: BLE001 - every query is reported
            problems, rows = [f"{type(error).__name__}: {str(error)[:600]}"], -1
        failed += bool(problems)
        mark = "FAIL" if problems else ("ok" if name in oracle else "ok (rows)")
        print(f"{mark:9} {name:32} {rows:>7} rows {time.time() - start:6.2f}s {problems or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    raise SystemExit(min(main(), 1))
