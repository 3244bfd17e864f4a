"""Daily reconciliation of a legacy extract with the landed order events, order by order."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.functions import numbers as N
from orderflow.functions.orders import amount_of
from orderflow.functions.text import is_blank, trimmed


def resolve_run_date(run_date: str | None) -> str:
    """A strict ``yyyy-MM-dd`` date; blank means yesterday in UTC."""
    if run_date is None or not run_date.strip():
        today = datetime.datetime.now(datetime.timezone.utc).date()
        return (today - datetime.timedelta(days=1)).isoformat()
    try:
        day = datetime.datetime.strptime(run_date, "%Y-%m-%d").date()
    except ValueError:
        day = None
    if day is None or day.isoformat() != run_date:
        raise ValueError(f"run date must be yyyy-MM-dd, got '{run_date}'")
    return run_date


def effective_total(total: Column, lines: Column) -> Column:
    """The extract's own total, else the sum of quantity times price over the lines."""
    summed = F.aggregate(
        lines, F.lit(0.0), lambda acc, line: acc + amount_of(line["qty"], line["price"])
    )
    return F.coalesce(total, summed, F.lit(0.0))


def to_legacy_rows(legacy: DataFrame, run_date: str, now: Column | None = None) -> DataFrame:
    """Legacy table rows, 11 columns; the order date stays as it was written."""
    return legacy.select(
        F.lit(run_date).alias("extract_date"),
        F.col("source_file").alias("extract_file"),
        "order_nbr",
        "order_type",
        "store_nbr",
        "cust_nbr",
        "order_date",
        effective_total(F.col("total_amount"), F.col("lines")).alias("total_amount"),
        F.size("lines").cast("bigint").alias("line_count"),
        F.col("lines").cast(S.LEGACY_OMS_ORDERS.schema["lines"].dataType).alias("lines"),
        (F.current_timestamp() if now is None else now).alias("loaded_at"),
    )


def key_legacy(legacy: DataFrame) -> DataFrame:
    """The legacy side keyed by trimmed order number; blank numbers have no key.

    Totals and counts are taken here, so that lines do not travel through the join.
    """
    number = F.col("order_nbr")
    return legacy.where(~is_blank(number)).select(
        trimmed(number).alias("order_id"),
        effective_total(F.col("total_amount"), F.col("lines")).alias("legacy_total"),
        F.size("lines").cast("bigint").alias("legacy_line_count"),
        F.col("store_nbr").alias("legacy_store"),
        "source_file",
        "position",
    )


def summarize_events(rows: DataFrame) -> DataFrame:
    """Order event rows to the few columns the reconciliation needs.

    Rows of other event types go; a row without a type stays. The order id is not trimmed.
    """
    if "lines" in rows.columns:
        listed = F.when(F.col("lines").isNotNull(), F.size("lines")).otherwise(0).cast("bigint")
    else:
        listed = F.lit(0).cast("bigint")
    count = F.when(F.col("line_count").isNotNull(), N.lenient_long(F.col("line_count"))).otherwise(listed)
    return _reconcilable(rows).where(~_unreadable(rows)).select(
        "order_id",
        F.col("store_id").alias("pubsub_store"),
        F.col("event_time").cast("string").alias("event_time"),
        N.lenient_double(F.col("total_amount")).alias("pubsub_total"),
        count.alias("pubsub_line_count"),
    )


def unreadable_events(rows: DataFrame) -> DataFrame:
    """Rows whose total or line count is text that is no number: reported, not guessed."""
    return _reconcilable(rows).where(_unreadable(rows))


def unreadable_letters(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """Dead letters of ``unreadable_events``, each with its row as JSON."""
    return unreadable_events(rows).select(
        F.lit(S.REJECTED_TOPIC_PREFIX + S.ORDER_EVENTS.name).alias("original_topic"),
        F.lit(S.STAGE_PARSE).alias("stage"),
        F.concat(F.lit("total or line count is no number, order "), F.col("order_id")).alias("reason"),
        F.to_json(F.struct(*rows.columns)).alias("payload"),
        F.create_map(F.lit(S.REJECTED_TABLE_ATTRIBUTE), F.lit(S.ORDER_EVENTS.name)).alias("attributes"),
        F.lit(None).cast("string").alias("message_id"),
        (F.current_timestamp() if now is None else now).alias("failed_at"),
    )


def _reconcilable(rows: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return rows.where((kind.isNull() | (kind == S.ORDER_CREATED)) & ~is_blank(F.col("order_id")))


def _unreadable(rows: DataFrame) -> Column:
    checks = [N.is_not_number(F.col(c)) for c in ("total_amount", "line_count")]
    return F.coalesce(checks[0], F.lit(False)) | F.coalesce(checks[1], F.lit(False))


def first_legacy(keyed: DataFrame) -> DataFrame:
    """One legacy order per id: the first by file and place in it. Combines map-side."""
    value = F.struct("legacy_total", "legacy_line_count", "legacy_store", "source_file")
    return (
        keyed.groupBy("order_id")
        .agg(F.min_by(value, F.struct("source_file", "position")).alias("legacy"))
        .select("order_id", "legacy.*", F.lit(True).alias("in_legacy"))
    )


def latest_event(summaries: DataFrame) -> DataFrame:
    """One event per order id: the latest by event time as text, a missing time last.

    Equal times are settled by the remaining values, so that a re-run gives the same answer.
    """
    value = F.struct("event_time", "pubsub_total", "pubsub_line_count", "pubsub_store")
    return (
        summaries.groupBy("order_id")
        .agg(F.max(value).alias("event"))
        .select(
            "order_id",
            "event.pubsub_total",
            "event.pubsub_line_count",
            "event.pubsub_store",
            F.lit(True).alias("in_events"),
        )
    )


def reconcile(
    legacy: DataFrame, events: DataFrame, run_date: str, tolerance: float = 0.01
) -> DataFrame:
    """Full outer join of both sides on the order id, classified.

    Both sides are cut to one row per id by aggregations on that id; the join reuses their
    partitioning, so each side is shuffled once.
    """
    left = first_legacy(key_legacy(legacy))
    right = latest_event(summarize_events(events))
    return classify(left.join(right, "order_id", "full_outer"), run_date, tolerance)


def classify(joined: DataFrame, run_date: str, tolerance: float = 0.01) -> DataFrame:
    legacy, pubsub = F.col("legacy_total"), F.col("pubsub_total")
    diff = legacy - pubsub
    no_event, no_legacy = F.col("in_events").isNull(), F.col("in_legacy").isNull()
    kind = (
        F.when(no_event, S.MISSING_IN_PUBSUB)
        .when(no_legacy, S.MISSING_IN_LEGACY)
        .when(F.abs(diff) > tolerance, S.AMOUNT_MISMATCH)
        .when(F.col("legacy_line_count") != F.col("pubsub_line_count"), S.LINE_COUNT_MISMATCH)
        .otherwise(S.MATCH)
    )
    # The texts are fixed values of the output.
    detail = (
        F.when(
            F.col("classification") == S.MISSING_IN_PUBSUB,
            F.concat(
                F.lit("order present in legacy OMS extract "),
                F.coalesce("source_file", F.lit("null")),
                F.lit(" but no ORDER_CREATED event in BigQuery"),
            ),
        )
        .when(
            F.col("classification") == S.MISSING_IN_LEGACY,
            F.lit("ORDER_CREATED event in BigQuery but order absent from legacy OMS extract"),
        )
        .when(
            F.col("classification") == S.AMOUNT_MISMATCH,
            F.format_string(
                "legacy total %.2f vs pubsub total %.2f (tolerance %.2f)", legacy, pubsub, F.lit(tolerance)
            ),
        )
        .when(
            F.col("classification") == S.LINE_COUNT_MISMATCH,
            F.format_string(
                "legacy lines %d vs pubsub lines %d",
                F.col("legacy_line_count"),
                F.col("pubsub_line_count"),
            ),
        )
    )
    return joined.withColumn("classification", kind).select(
        F.lit(run_date).alias("run_date"),
        "order_id",
        "classification",
        "legacy_total",
        "pubsub_total",
        diff.alias("amount_diff"),
        "legacy_line_count",
        "pubsub_line_count",
        "legacy_store",
        "pubsub_store",
        detail.alias("detail"),
    )


def scorecard(results: DataFrame) -> DataFrame:
    """Orders per classification; classes that do not occur are left out."""
    return (
        results.groupBy("run_date", "classification")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("classification")
    )


def to_reconciliation_rows(results: DataFrame, run_id: str = "local", now: Column | None = None) -> DataFrame:
    """Reconciliation table rows, 13 columns."""
    return results.select(
        "run_date",
        F.lit(run_id).alias("run_id"),
        "order_id",
        "classification",
        "legacy_total",
        "pubsub_total",
        "amount_diff",
        "legacy_line_count",
        "pubsub_line_count",
        "legacy_store",
        "pubsub_store",
        "detail",
        (F.current_timestamp() if now is None else now).alias("checked_at"),
    )


def daily_scorecard(table: DataFrame, run_date: str) -> DataFrame:
    """Orders per date and classification for the newest run of ``run_date``."""
    newest = table.where(F.col("run_date") == F.lit(run_date).cast("date")).agg(
        F.max("run_id").alias("run_id")
    )
    # ``newest`` is one row by construction.
    return (
        table.join(F.broadcast(newest), "run_id", "left_semi")
        .groupBy("run_date", "classification")
        .agg(F.count(F.lit(1)).alias("orders"))
        .orderBy("run_date", "classification")
    )
