"""Landed messages to tables in one batch run: the streaming job's tables without its panes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.operators import deadletter, enrich, metrics, parse
from orderflow.operators.skew import fits_broadcast
from orderflow.session import staged
from orderflow.sinks import append_table, write_messages


def backfill(
    orders: DataFrame,
    inventory: DataFrame,
    shipments: DataFrame,
    stores: DataFrame,
    out: str,
    dead_letters: str,
) -> DataFrame:
    """Writes all event tables and dead letters; returns the final store metrics.

    Each stream is parsed once into a staged table split by outcome; the tables then read only
    the columns and the outcome they need.
    """
    now = F.current_timestamp()
    small = fits_broadcast(stores)
    valid, dead = {}, []
    for kind, messages in (("orders", orders), ("inventory", inventory), ("shipments", shipments)):
        judged = parse.validate(messages, kind).withColumn("ok", F.col("stage").isNull())
        kept = staged(judged, kind, partition_by="ok")
        valid[kind] = parse.valid_of(kept.where("ok"))
        dead.append(parse.dead_of(kept.where("not ok"), S.TOPICS[kind], now))
    enriched = enrich.enrich_with_store(valid["orders"], stores, small)
    outputs = {
        S.ORDER_EVENTS: enrich.to_order_events(enriched, now),
        S.ORDER_LINES: enrich.to_order_lines(enriched, now),
        S.INVENTORY_EVENTS: enrich.to_inventory_events(valid["inventory"], now),
        S.SHIPMENT_EVENTS: enrich.to_shipment_events(valid["shipments"], now),
    }
    for table, rows in outputs.items():
        accepted, refused = deadletter.conform(rows, table, now)
        append_table(accepted, table, out)
        dead.append(refused)
    everything = deadletter.union_dead_letters(*dead)
    append_table(deadletter.to_dead_letter_rows(everything), S.DEAD_LETTER, out)
    write_messages(deadletter.to_dlq_messages(everything), dead_letters)
    return metrics.store_metrics_final(metrics.created_by_store(valid["orders"]))
