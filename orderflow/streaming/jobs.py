"""The streaming job: three message streams to event tables, store metrics and dead letters.

Each stream is one query; store metrics are one more over the orders, whose windows are state of Spark's own (see
``panes``). A micro-batch is evaluated once, kept for its duration, and written to all tables it feeds. Every write goes
to a partition of its own batch, so a repeated attempt after a lost executor or driver replaces what the first one wrote.
"""

from __future__ import annotations

import datetime
import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from orderflow import schemas as S
from orderflow.operators import counters, deadletter, enrich, events, metrics, parse
from orderflow.session import use_utc
from orderflow.sinks.files import write_jsonl
from orderflow.sinks.messages import write_messages
from orderflow.sinks.tables import write_batch
from orderflow.streaming.panes import pane_rows, store_panes

log = logging.getLogger(__name__)

#: Micro-batches whose counts are remembered.
COUNTED_BATCHES = 1000


@dataclass(frozen=True)
class StreamSettings:
    """Where the job writes and how it aggregates.

    ``out`` holds the tables, ``checkpoints`` the progress and state of the queries. Dead-letter messages go to
    ``dead_letters``: a folder, or a topic if ``dead_letter_format`` is ``kafka`` (with ``dead_letter_options``). With
    ``jsonl`` rows are written as JSON lines, unchecked, and no messages are sent. ``early_seconds`` is the time
    between two rows of totals so far. With ``dedupe_minutes`` a message that comes again within that time (the same
    ``message_id``) is left out. ``counts`` has the numbers of the latest micro-batches, among them ``dropped_late``,
    the rows that came after the allowed lateness (or repeated messages after their time).
    """

    out: str
    checkpoints: str
    dead_letters: str | None = None
    dead_letter_format: str = "json"
    dead_letter_options: dict = field(default_factory=dict)
    jsonl: bool = False
    exactly_once: bool = True
    flush_seconds: int = 10
    window_minutes: int = 1
    lateness_minutes: int = 5
    early_seconds: int = 30
    dedupe_minutes: int = 0
    counts: dict = field(default_factory=dict, compare=False)

    def __post_init__(self):
        if not self.jsonl and not self.dead_letters:
            raise ValueError("a dead-letter folder or topic is required unless rows go to JSON lines")

    def count(self, kind: str, batch_id: int, values: dict) -> None:
        self.counts.setdefault((kind, batch_id), {}).update(values)
        while len(self.counts) > COUNTED_BATCHES:
            self.counts.pop(next(iter(self.counts)))
        log.info("%s batch %d: %s", kind, batch_id, values)


def start_streams(
    orders: DataFrame,
    inventory: DataFrame,
    shipments: DataFrame,
    stores: DataFrame | Callable[[], DataFrame],
    settings: StreamSettings,
    available_now: bool = False,
) -> list[StreamingQuery]:
    """Starts the four queries. ``available_now`` processes what is there and stops.

    ``stores`` may be a function: it is then called for each micro-batch of orders, so that a
    store list that changes is followed.
    """
    spark = use_utc(orders.sparkSession)
    s = settings
    timed = orders
    if s.dedupe_minutes:
        within = f"{s.dedupe_minutes} minutes"
        # Metrics have one watermark, their lateness; repeated orders are known as long.
        timed = events.dedupe_stream(orders, f"{s.lateness_minutes} minutes", "message_id")
        orders, inventory, shipments = (events.dedupe_stream(m, within, "message_id") for m in (orders, inventory, shipments))
    created = metrics.created_by_store(parse.valid_of(parse.validate(timed, "orders")))
    minutes = [datetime.timedelta(minutes=m) for m in (s.window_minutes, s.lateness_minutes)]
    panes = store_panes(created, *minutes, watermarked=bool(s.dedupe_minutes))
    batches = [
        (orders, OrdersBatch(stores, s), s.flush_seconds),
        (inventory, EventsBatch("inventory", s), s.flush_seconds),
        (shipments, EventsBatch("shipments", s), s.flush_seconds),
        (panes, MetricsBatch(s), s.early_seconds),
    ]
    spark.streams.addListener(DroppedRows(s, [batch.kind for _, batch, _ in batches]))
    return [_start(rows, batch, "append", seconds, available_now) for rows, batch, seconds in batches]


class DroppedRows(StreamingQueryListener):
    """Counts the rows that the watermark dropped, for one run of each of the queries ``kinds``."""

    def __init__(self, settings: StreamSettings, kinds: list[str]):
        self.settings, self.waiting, self.runs = settings, list(kinds), {}

    def onQueryStarted(self, event) -> None:
        if event.name in self.waiting:
            self.waiting.remove(event.name)
            self.runs[event.runId] = event.name

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.runId in self.runs and progress.stateOperators:
            dropped = sum(state.numRowsDroppedByWatermark for state in progress.stateOperators)
            self.settings.count(self.runs[progress.runId], progress.batchId, {"dropped_late": dropped})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.runs.pop(event.runId, None)


def _start(stream: DataFrame, batch: _Batch, mode: str, seconds: int, available_now: bool) -> StreamingQuery:
    writer = stream.writeStream.queryName(batch.kind).outputMode(mode).option(
        "checkpointLocation", f"{batch.settings.checkpoints}/{batch.kind}"
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{seconds} seconds")
    return writer.foreachBatch(batch).start()


class _Batch:
    """What micro-batches share: frames that are kept while it lasts, checked writes, dead letters."""

    kind: str

    def __init__(self, settings: StreamSettings):
        self.settings = settings
        self._kept: list[DataFrame] = []

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        self.moment = F.lit(datetime.datetime.now(datetime.timezone.utc))
        try:
            self.run(rows, batch_id)
        finally:
            while self._kept:
                self._kept.pop().unpersist()

    def run(self, rows: DataFrame, batch_id: int) -> None:
        raise NotImplementedError

    def keep(self, df: DataFrame) -> DataFrame:
        kept = df.persist(StorageLevel.MEMORY_AND_DISK)
        self._kept.append(kept)
        return kept

    def _name(self, batch_id: int) -> str:
        return f"{self.kind}-{batch_id}"

    def _write(self, rows: DataFrame, table: S.Table, batch_id: int) -> list[DataFrame]:
        """Writes accepted rows; returns the dead letters of refused ones. The rows are evaluated once."""
        s = self.settings
        if s.jsonl:
            write_jsonl(rows, f"{s.out}/{table.name}", f"batch={self._name(batch_id)}", "overwrite")
            return []
        checked = self.keep(deadletter.check_rows(rows, table))
        accepted = checked.where(F.col("refusal").isNull()).select("accepted.*")
        write_batch(accepted, table, s.out, self._name(batch_id), exactly_once=s.exactly_once)
        failed = checked.where(F.col("refusal").isNotNull()).count()
        s.count(self.kind, batch_id, {f"failed_inserts.{table.name}": failed})
        return [deadletter.refused_rows(checked, table, self.moment)]

    def _write_dead(self, dead: DataFrame, batch_id: int, day: datetime.date | None) -> None:
        s = self.settings
        name = self._name(batch_id)
        dead = self.keep(dead)
        rows = deadletter.to_dead_letter_rows(dead)
        if s.jsonl:
            write_jsonl(rows, f"{s.out}/{S.DEAD_LETTER.name}", f"batch={name}", "overwrite")
            return
        write_batch(rows, S.DEAD_LETTER, s.out, name, day=F.lit(day).cast("date"), exactly_once=s.exactly_once)
        letters = deadletter.to_dlq_messages(dead)
        if s.dead_letter_format == "kafka":
            write_messages(letters, s.dead_letters, "kafka", **s.dead_letter_options)
        else:
            write_messages(letters, f"{s.dead_letters}/batch={name}", s.dead_letter_format, "overwrite")


class _MessagesBatch(_Batch):
    """Messages are parsed once, written to their tables, and the rest to the dead letters."""

    def run(self, rows: DataFrame, batch_id: int) -> None:
        judged = self.keep(parse.validate(rows, self.kind))
        counted, seen = counters.count_parsed(judged, f"{self.kind}-{batch_id}")
        # The day follows the messages, not the clock: a repeated attempt must hit the same place.
        day = counted.agg(F.to_date(F.max("publish_time"))).first()[0]
        self.settings.count(self.kind, batch_id, seen.get)
        valid, dead = parse.split_valid(judged, S.TOPICS[self.kind], self.moment)
        refused = self.write_tables(valid, batch_id)
        self._write_dead(deadletter.union_dead_letters(dead, *refused), batch_id, day)

    def write_tables(self, valid: DataFrame, batch_id: int) -> list[DataFrame]:
        raise NotImplementedError


class EventsBatch(_MessagesBatch):
    """Inventory or shipment messages to their event table."""

    def __init__(self, kind: str, settings: StreamSettings):
        super().__init__(settings)
        self.kind = kind

    def write_tables(self, valid, batch_id):
        if self.kind == "inventory":
            return self._write(enrich.to_inventory_events(valid, self.moment), S.INVENTORY_EVENTS, batch_id)
        return self._write(enrich.to_shipment_events(valid, self.moment), S.SHIPMENT_EVENTS, batch_id)


class OrdersBatch(_MessagesBatch):
    """Order messages to order_events and order_lines."""

    kind = "orders"

    def __init__(self, stores: DataFrame | Callable[[], DataFrame], settings: StreamSettings):
        super().__init__(settings)
        self.stores = stores

    def write_tables(self, valid, batch_id):
        # The list is measured anew in each batch, as the file behind it may have grown.
        stores = self.stores() if callable(self.stores) else self.stores
        enriched = self.keep(enrich.enrich_with_store(valid, stores))
        counted, seen = counters.count_enriched(enriched)
        counted.agg(F.count(F.lit(1))).collect()
        self.settings.count(self.kind, batch_id, seen.get)
        refused = self._write(enrich.to_order_events(enriched, self.moment), S.ORDER_EVENTS, batch_id)
        return refused + self._write(enrich.to_order_lines(enriched, self.moment), S.ORDER_LINES, batch_id)


class MetricsBatch(_Batch):
    """Panes to store_order_metrics."""

    kind = "metrics"

    def run(self, rows, batch_id):
        panes = self.keep(rows)
        day = panes.agg(F.to_date(F.max("window_start"))).first()[0]
        if day is None:
            return
        refused = self._write(pane_rows(panes, self.moment), S.STORE_ORDER_METRICS, batch_id)
        if refused and not refused[0].isEmpty():
            self._write_dead(deadletter.union_dead_letters(*refused), batch_id, day)
