"""Compare registered queries with their SQL twins: ``check_oracles.py <folder> [names]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tests.comparison import connect, duckdb_result, spark_result  # noqa: E402


def main(folder: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    statements = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.perf_counter()
        try:
            types, rows = spark_result(query(spark, folder))
            elapsed = time.perf_counter() - start
            if name not in statements:
                print(f"{name}: {len(rows)} rows, no twin ({elapsed:.2f}s)")
                continue
            other_types, other_rows = duckdb_result(connection, statements[name])
        except Exception as error:  # report every query
            bad += 1
            print(f"{name}: ERROR {str(error)[:600]}")
            continue
        notes = []
        if types != other_types:
            notes.append(f"types {sorted(set(types.items()) ^ set(other_types.items()))}")
        if rows != other_rows:
            extra = sorted(set(rows) - set(other_rows), key=repr)[:2]
            lacking = sorted(set(other_rows) - set(rows), key=repr)[:2]
            notes.append(f"rows {len(rows)} / {len(other_rows)}: {extra} / {lacking}")
        bad += bool(notes)
        print(f"{name}: {len(rows)} rows {elapsed:.2f}s {'; '.join(notes) or 'ok'}", flush=True)
    print(f"{bad} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
