"""Store metrics as panes: totals so far, the total at a window's end, and one more for each late order.

The clock is Spark's watermark, which trails the newest publish time by the allowed lateness. A window ends when
the newest publish time passes its end, so the watermark is the lateness before it then, and the window is closed, and
its state dropped, when the watermark itself passes the end. Two timers of a window wait for these moments.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator
from decimal import Decimal, getcontext
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from orderflow.functions import numbers as N
from orderflow.operators import metrics as M

#: Timers are kept by this provider only.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_TOTALS = "orders bigint, exact decimal(38,6), beyond double, alteration_lines bigint, rental_orders bigint"
_STATE = f"{_TOTALS}, panes bigint, ended boolean"
_PANE = (
    "store_id string, window_start timestamp, window_end timestamp, pane_timing string, pane_index bigint, is_last boolean, "
    "orders bigint, revenue double, alteration_lines bigint, rental_orders bigint"
)


class StorePanes(StatefulProcessor):
    """Running totals of one store and window."""

    def __init__(self, lateness: datetime.timedelta):
        self.lateness = int(lateness.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        getcontext().prec = 38
        self.handle = handle
        self.state = handle.getValueState("totals", _STATE)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        now, end = timerValues.getCurrentWatermarkInMs(), _millis(key[2])
        orders, exact, beyond, alterations, rentals, panes, ended = self._read()
        out = []
        if now >= end - self.lateness and not ended:
            # The window ended before these rows came: its own pane goes first, if it had any order.
            if orders:
                out.append((M.ON_TIME, panes, orders, exact, beyond, alterations, rentals))
                panes += 1
            ended = True
        if not orders:
            if not ended:
                self.handle.registerTimer(end - self.lateness)
            self.handle.registerTimer(end)
        for batch in rows:
            for row in (zip(*(batch[c] for c in _COLUMNS)) if ended else [_summed(batch)]):
                orders, exact, beyond = orders + 1 if ended else orders + row[0], exact + row[1], beyond + row[2]
                alterations, rentals = alterations + int(row[3]), rentals + int(row[4])
                if ended:
                    out.append((M.LATE, panes, orders, exact, beyond, alterations, rentals))
                    panes += 1
        if not ended:
            out.append((M.EARLY, panes, orders, exact, beyond, alterations, rentals))
            panes += 1
        self.state.update((orders, exact, beyond, alterations, rentals, panes, ended))
        yield self._panes(key, out)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        orders, exact, beyond, alterations, rentals, panes, ended = self._read()
        out = []
        if orders and not ended:
            out.append((M.ON_TIME, panes, orders, exact, beyond, alterations, rentals))
            self.state.update((orders, exact, beyond, alterations, rentals, panes + 1, True))
        if expiredTimerInfo.getExpiryTimeInMs() >= _millis(key[2]):
            self.state.clear()
        if out:
            yield self._panes(key, out)

    def _read(self) -> tuple:
        return tuple(self.state.get()) if self.state.exists() else (0, Decimal(0), 0.0, 0, 0, 0, False)

    def _panes(self, key: Any, panes: list[tuple]) -> pd.DataFrame:
        rows = [
            (*key, timing, index, timing == M.ON_TIME and not self.lateness, orders, float(exact) + beyond, alterations, rentals)
            for timing, index, orders, exact, beyond, alterations, rentals in panes
        ]
        return pd.DataFrame(rows, columns=[part.split()[0] for part in _PANE.split(", ")])


_COLUMNS = ["orders", "exact", "beyond", "alteration_lines", "is_rental"]


def _summed(batch: pd.DataFrame) -> tuple:
    return (
        len(batch), sum(batch["exact"], Decimal(0)), float(batch["beyond"].sum()),
        int(batch["alteration_lines"].sum()), int(batch["is_rental"].sum()),
    )


def _millis(moment: Any) -> int:
    stamp = pd.Timestamp(moment)
    return int((stamp.tz_localize("UTC") if stamp.tzinfo is None else stamp).timestamp() * 1000)


def store_panes(
    created: DataFrame, window: datetime.timedelta, lateness: datetime.timedelta, watermarked: bool = False
) -> DataFrame:
    """The panes of a stream of created orders, per store and window of publish time (``created_by_store``).

    A micro-batch gives one EARLY row for each window it touched before its end, one ON_TIME row when the window
    has ended, and one LATE row for every order that comes after that. Each row is the whole total so far; ``pane_index``
    counts a window's rows from 0. Orders that come when the lateness is over (by the watermark of the micro-batch
    before) are left out; Spark counts them as dropped by the watermark. ``is_last`` is true only where no lateness is allowed. ``watermarked`` rows have a
    watermark of ``lateness`` already.
    """
    spark = created.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    size, delay = (f"{int(d.total_seconds())} seconds" for d in (window, lateness))
    marked = created if watermarked else created.withWatermark("publish_time", delay)
    amount = F.col("total_amount")
    # The window carries the watermark, so that an order is too late only once its whole window is.
    windowed = marked.select(
        "store_id",
        F.window("publish_time", size).alias("window"),
        F.lit(1).cast("long").alias("orders"),
        F.coalesce(N.exact_money(amount), F.lit(0)).cast("decimal(38,6)").alias("exact"),
        N.beyond_money(amount).alias("beyond"),
        F.coalesce("alteration_lines", F.lit(0)).cast("long").alias("alteration_lines"),
        F.coalesce("is_rental", F.lit(False)).alias("is_rental"),
    )
    keyed = windowed.select("*", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"))
    grouped = keyed.groupBy("store_id", "window_start", "window_end")
    return grouped.transformWithStateInPandas(StorePanes(lateness), _PANE, "append", "EventTime")


def pane_rows(panes: DataFrame, now: Column | None = None) -> DataFrame:
    """Table rows of panes."""
    return panes.withColumn("emitted_at", F.current_timestamp() if now is None else now)
