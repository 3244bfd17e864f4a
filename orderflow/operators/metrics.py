"""Per-store order metrics in tumbling windows of publish time, and the queries on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.functions import numbers as N
from orderflow.functions import orders as O
from orderflow.functions.times import to_timestamp

WINDOW = "1 minute"
LATENESS = "5 minutes"
EARLY, ON_TIME, LATE = "EARLY", "ON_TIME", "LATE"


def created_by_store(valid: DataFrame) -> DataFrame:
    """ORDER_CREATED events that name a store, reduced to what the metrics need."""
    order = F.col("event.order")
    return valid.where(
        (F.col("event.eventType") == S.ORDER_CREATED) & order.isNotNull() & order["storeId"].isNotNull()
    ).select(
        order["storeId"].alias("store_id"),
        "publish_time",
        to_timestamp(F.col("event.eventTime")).alias("event_time"),
        "message_id",
        order["totalAmount"].alias("total_amount"),
        O.alteration_line_count(order["lines"]).alias("alteration_lines"),
        O.is_rental(order).alias("is_rental"),
    )


def metric_aggregates() -> list[Column]:
    """Orders, revenue, alteration lines, rental orders. All combine map-side."""
    return [
        F.count(F.lit(1)).alias("orders"),
        N.money_sum(F.col("total_amount")).alias("revenue"),
        F.coalesce(F.sum("alteration_lines"), F.lit(0)).cast("bigint").alias("alteration_lines"),
        F.count_if(F.col("is_rental")).alias("rental_orders"),
    ]


def store_metrics_final(
    created: DataFrame, window: str = WINDOW, lateness: str = LATENESS, time: str = "publish_time"
) -> DataFrame:
    """The complete answer per store and window, without panes.

    In a stream a row appears once its window is closed (append mode): ``lateness`` after its end.
    ``time`` may name ``event_time`` to window on business time.
    """
    return store_metrics_running(created, window, lateness, time).drop("last_seen")


def store_metrics_running(
    created: DataFrame, window: str = WINDOW, lateness: str = LATENESS, time: str = "publish_time"
) -> DataFrame:
    """The same with ``last_seen``, the latest time in the window.

    In a stream in update mode each micro-batch gives the totals so far of the windows it touched.
    """
    return (
        created.withWatermark(time, lateness)
        .groupBy("store_id", F.window(time, window).alias("window"))
        .agg(*metric_aggregates(), F.max(time).alias("last_seen"))
        .select(
            "store_id",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "orders",
            "revenue",
            "alteration_lines",
            "rental_orders",
            "last_seen",
        )
    )


def running_rows(totals: DataFrame, clock: Column, now: Column | None = None) -> DataFrame:
    """Table rows of totals so far: LATE if the window had ended at ``clock``, else EARLY.

    Totals only grow, so the number of orders (less one) numbers the rows of a window in their order, whichever
    micro-batch they come from.
    """
    timing = F.when(F.col("window_end") <= clock, LATE).otherwise(EARLY)
    return _metric_rows(totals, timing, F.col("orders") - 1, F.lit(False), now)


def final_rows(totals: DataFrame, now: Column | None = None) -> DataFrame:
    """Table rows of complete windows; they come after all rows of totals so far."""
    return _metric_rows(totals, F.lit(ON_TIME), F.col("orders"), F.lit(True), now)


def _metric_rows(totals: DataFrame, timing: Column, index: Column, is_last: Column, now: Column | None) -> DataFrame:
    return totals.select(
        "store_id",
        "window_start",
        "window_end",
        timing.alias("pane_timing"),
        index.cast("bigint").alias("pane_index"),
        is_last.alias("is_last"),
        "orders",
        "revenue",
        "alteration_lines",
        "rental_orders",
        (F.current_timestamp() if now is None else now).alias("emitted_at"),
    )


def latest_panes(panes: DataFrame, now: Column | None = None) -> DataFrame:
    """The pane with the highest index per store and window, for windows of the last hour."""
    now = F.current_timestamp() if now is None else now
    latest = Window.partitionBy("store_id", "window_start").orderBy(F.col("pane_index").desc())
    return (
        panes.where(F.col("window_start") >= now - F.expr("interval 1 hour"))
        .withColumn("rn", F.row_number().over(latest))
        .where("rn = 1")
        .drop("rn")
    )


def recent_metrics(panes: DataFrame, limit: int = 20) -> DataFrame:
    """The newest panes, at most ``limit`` (a top-k: no full sort)."""
    return (
        panes.select("store_id", "window_start", "pane_timing", "pane_index", "orders", "revenue")
        .orderBy(F.col("window_start").desc(), F.col("pane_index").desc(), "store_id")
        .limit(limit)
        .drop("pane_index")
    )
