"""JSON-lines tables and small CSV reports."""

from __future__ import annotations

from pyspark.sql import DataFrame

from orderflow.functions.times import iso_if_time


def write_jsonl(df: DataFrame, root: str, table: str, mode: str = "append", compression: str = "none") -> None:
    """One compact JSON object per row under ``root/<table>``; null columns are left out.

    Compressed files (``gzip``, ``zstd``) are read like plain ones, each by one task.
    """
    writer = json_rows(df).write.mode(mode).option("ignoreNullFields", "true")
    writer.json(f"{root}/{table}", compression=compression)


def json_rows(df: DataFrame) -> DataFrame:
    """Rows with all times as RFC-3339 texts."""
    return df.select(*(iso_if_time(field) for field in df.schema))


def write_csv_report(report: DataFrame, path: str) -> None:
    """One CSV file with a header under ``path``, in column order; for aggregated reports.

    ``repartition`` rather than ``coalesce``: the latter would also pull the aggregation that
    makes the report into its single task.
    """
    one = report.repartition(1).sortWithinPartitions(*report.columns)
    one.write.mode("overwrite").csv(path, header=True)
