"""Order events already landed, as a table or as JSON lines."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.functions.text import is_blank
from orderflow.functions.times import to_iso_millis
from orderflow.operators.barrier import sealed
from orderflow.schemas import ORDER_CREATED

# What the reconciliation needs; total and counts may arrive as text, ``lines`` only sizes the order.
_JSONL = (
    "order_id string, store_id string, event_type string, event_time string, "
    "total_amount string, line_count string, lines string"
)


def read_order_events(spark: SparkSession, path: str, run_date: str, last_date: str | None = None) -> DataFrame:
    """ORDER_CREATED rows of one UTC day (or of all days up to ``last_date``); ``event_date`` prunes partitions."""
    return created_on(spark.read.parquet(path), run_date, last_date)


def is_created_on(event_type: Column, event_time: Column, run_date: str, last_date: str | None = None) -> Column:
    """Whether an event is an ORDER_CREATED of one UTC day (or of all days up to ``last_date``)."""
    day, last = datetime.date.fromisoformat(run_date), datetime.date.fromisoformat(last_date or run_date)
    start = datetime.datetime(day.year, day.month, day.day, tzinfo=datetime.timezone.utc)
    end = datetime.datetime(last.year, last.month, last.day, tzinfo=datetime.timezone.utc) + datetime.timedelta(days=1)
    return (event_type == ORDER_CREATED) & (event_time >= F.lit(start)) & (event_time < F.lit(end))


def created_on(order_events: DataFrame, run_date: str, last_date: str | None = None) -> DataFrame:
    day, last = datetime.date.fromisoformat(run_date), datetime.date.fromisoformat(last_date or run_date)
    if "event_date" in order_events.columns:
        order_events = order_events.where(F.col("event_date").between(F.lit(day), F.lit(last)))
    wanted = is_created_on(F.col("event_type"), F.col("event_time"), run_date, last_date)
    return order_events.where(wanted).select(
        "order_id",
        "store_id",
        "event_type",
        to_iso_millis(F.col("event_time")).alias("event_time"),
        "total_amount",
        "line_count",
    )


def read_jsonl_events(spark: SparkSession, path: str) -> DataFrame:
    """Order event rows from JSON lines; blank and malformed lines are skipped.

    No date filter here: a local file is taken to be the day's extract.
    """
    return jsonl_events(spark.read.text(path))


def jsonl_events(lines: DataFrame) -> DataFrame:
    return events_of(judged_lines(lines))


def judged_lines(lines: DataFrame) -> DataFrame:
    """Parsed JSON lines with ``skipped``, true for a line that is not blank and holds no JSON object.

    Blank lines are there too, with ``skipped`` null; ``events_of`` leaves the rows of the others.
    """
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "malformed",
        "allowSingleQuotes": "false",
        "allowNonNumericNumbers": "false",
    }
    row = F.from_json("value", _JSONL + ", malformed string", options)
    parsed = sealed(lines, [], row.alias("row"), is_blank(F.col("value")).alias("blank"))
    # A text without any JSON object leaves every column null.
    fields = [f.name for f in parsed.schema["row"].dataType]
    nothing = F.coalesce(*(F.col(f"row.{name}").cast("string") for name in fields)).isNull()
    skipped = F.when(~F.col("blank"), F.col("row.malformed").isNotNull() | nothing)
    return parsed.select("row.*", skipped.alias("skipped"))


def events_of(judged: DataFrame) -> DataFrame:
    kept = judged.where(~F.col("skipped")).drop("malformed", "skipped")
    return kept.withColumn("lines", F.from_json("lines", "array<string>"))
