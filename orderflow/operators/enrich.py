"""Store lookup and the flattening of events into table rows.

Rows keep the times of the payload as the RFC-3339 texts of the wire; ``deadletter.conform`` casts
them to a table's types and sends away what the table would refuse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.functions import orders as O
from orderflow.functions.text import json_of
from orderflow.operators.skew import lookup_join


def _now(now: Column | None) -> Column:
    return F.current_timestamp() if now is None else now


def enrich_with_store(orders: DataFrame, stores: DataFrame, small: bool | None = None) -> DataFrame:
    """Adds ``store_name``, ``region`` and ``timezone``; an unknown store gives nulls.

    Stream-static in a stream. The store list is broadcast only when measured small; pass the
    result of an earlier measurement as ``small`` to spare it.
    """
    keyed = orders.withColumn("store_id", F.col("event.order.storeId"))
    return lookup_join(keyed, stores, "store_id", ["message_id"], small=small).drop("store_id")


def _line_record(line: Column) -> Column:
    return F.struct(
        line["lineNumber"].cast("bigint").alias("line_number"),
        line["sku"].alias("sku"),
        line["quantity"].cast("bigint").alias("quantity"),
        line["unitPrice"].alias("unit_price"),
        line["fulfillmentType"].alias("fulfillment_type"),
        line["alteration"]["type"].alias("alteration_type"),
        line["alteration"]["measurementInches"].alias("alteration_measurement_inches"),
        line["alteration"]["tailorShopId"].alias("tailor_shop_id"),
    )


def _records(lines: Column, record, table: S.Table) -> Column:
    """A list of records: empty, never null."""
    return F.coalesce(F.transform(lines, record), F.array().cast(table.schema["lines"].dataType))


def to_order_events(enriched: DataFrame, now: Column | None = None) -> DataFrame:
    """One row per order event, 27 columns, lines nested."""
    e, o = F.col("event"), F.col("event.order")
    return enriched.select(
        e["eventId"].alias("event_id"),
        e["eventType"].alias("event_type"),
        e["eventTime"].alias("event_time"),
        e["schemaVersion"].alias("schema_version"),
        e["source"].alias("source"),
        e["correlationId"].alias("correlation_id"),
        e["legacyMessageId"].alias("legacy_message_id"),
        "message_id",
        "publish_time",
        o["orderId"].alias("order_id"),
        o["orderType"].alias("order_type"),
        o["channel"].alias("channel"),
        o["storeId"].alias("store_id"),
        "store_name",
        "region",
        o["customerId"].alias("customer_id"),
        o["orderedAt"].alias("ordered_at"),
        o["promisedDate"].alias("promised_date"),
        o["currency"].alias("currency"),
        o["totalAmount"].alias("total_amount"),
        O.line_count(o["lines"]).alias("line_count"),
        O.alteration_line_count(o["lines"]).alias("alteration_line_count"),
        O.is_rental(o).alias("is_rental"),
        _records(o["lines"], _line_record, S.ORDER_EVENTS).alias("lines"),
        json_of(o["rental"]).alias("rental_json"),
        json_of(o["shipTo"]).alias("ship_to_json"),
        _now(now).alias("ingested_at"),
    )


def to_order_lines(enriched: DataFrame, now: Column | None = None) -> DataFrame:
    """One row per order line; an order without lines gives none."""
    e, o = F.col("event"), F.col("event.order")
    line = F.col("line")
    return enriched.select("event", "region", F.explode(o["lines"]).alias("line")).select(
        e["eventId"].alias("event_id"),
        e["eventType"].alias("event_type"),
        e["eventTime"].alias("event_time"),
        o["orderId"].alias("order_id"),
        o["orderType"].alias("order_type"),
        o["channel"].alias("channel"),
        o["storeId"].alias("store_id"),
        "region",
        line["lineNumber"].cast("bigint").alias("line_number"),
        line["sku"].alias("sku"),
        line["quantity"].cast("bigint").alias("quantity"),
        line["unitPrice"].alias("unit_price"),
        O.amount_of(line["quantity"], line["unitPrice"]).alias("line_amount"),
        line["fulfillmentType"].alias("fulfillment_type"),
        line["alteration"]["type"].alias("alteration_type"),
        line["alteration"]["measurementInches"].alias("alteration_measurement_inches"),
        line["alteration"]["tailorShopId"].alias("tailor_shop_id"),
        _now(now).alias("ingested_at"),
    )


def to_inventory_events(valid: DataFrame, now: Column | None = None) -> DataFrame:
    """One row per inventory event, 13 columns, lines nested."""
    e = F.col("event")

    def record(line: Column) -> Column:
        return F.struct(
            line["lineNumber"].cast("bigint").alias("line_number"),
            line["sku"].alias("sku"),
            line["quantity"].cast("bigint").alias("quantity"),
            line["status"].alias("status"),
            line["locationId"].alias("location_id"),
        )

    return valid.select(
        e["eventId"].alias("event_id"),
        e["eventType"].alias("event_type"),
        e["eventTime"].alias("event_time"),
        e["schemaVersion"].alias("schema_version"),
        e["source"].alias("source"),
        e["correlationId"].alias("correlation_id"),
        "message_id",
        "publish_time",
        e["orderId"].alias("order_id"),
        e["storeId"].alias("store_id"),
        O.line_count(e["lines"]).alias("line_count"),
        _records(e["lines"], record, S.INVENTORY_EVENTS).alias("lines"),
        _now(now).alias("ingested_at"),
    )


def to_shipment_events(valid: DataFrame, now: Column | None = None) -> DataFrame:
    """One row per shipment event, 15 columns."""
    e = F.col("event")
    return valid.select(
        e["eventId"].alias("event_id"),
        e["eventType"].alias("event_type"),
        e["eventTime"].alias("event_time"),
        e["schemaVersion"].alias("schema_version"),
        e["source"].alias("source"),
        e["correlationId"].alias("correlation_id"),
        "message_id",
        "publish_time",
        e["orderId"].alias("order_id"),
        e["trackingNumber"].alias("tracking_number"),
        e["carrier"].alias("carrier"),
        e["status"].alias("status"),
        e["statusTime"].alias("status_time"),
        e["location"].alias("location"),
        _now(now).alias("ingested_at"),
    )
