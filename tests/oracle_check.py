"""Runs queries and their SQL side by side: ``python tests/oracle_check.py [sf_dir] [query...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402


def normal(value):
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(row[i]) for i in order) for row in rows)


def compare(spark, connection, name: str, sf_dir: str) -> str:
    """Empty text if both results agree, else what differs."""
    frame = entry.queries()[name](spark, sf_dir)
    got = rows_of(frame.columns, frame.collect())
    cursor = connection.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    want = rows_of(columns, cursor.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} instead of {sorted(columns)}"
    if got == want:
        return ""
    extra, missing = list((got - want).elements()), list((want - got).elements())
    return f"{len(extra)} rows too many, {len(missing)} missing\n   got  {extra[:3]}\n   want {missing[:3]}"


def connect(sf_dir: str):
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def main() -> None:
    from orderflow.session import get_spark

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = get_spark(
        "oracle-check", "local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
                                       "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, connection, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:400]}"
        bad += bool(problem)
        print(f"{'ok  ' if not problem else 'BAD '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
