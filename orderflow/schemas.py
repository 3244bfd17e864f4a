"""Wire structs, table schemas, required columns and table layout."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --------------------------------------------------------------------------- messages in

MESSAGE = T.StructType(
    [
        T.StructField("message_id", T.StringType()),
        T.StructField("publish_time", T.TimestampType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
        T.StructField("payload", T.StringType()),
    ]
)


_STRING, _DOUBLE, _BOOL = T.StringType(), T.DoubleType(), T.BooleanType()
_INT, _LONG = T.IntegerType(), T.LongType()
_TIME, _DATE = T.TimestampType(), T.DateType()


def _record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


ORDER_EVENT = _record(
    eventId=_STRING,
    eventType=_STRING,
    eventTime=_STRING,
    schemaVersion=_STRING,
    source=_STRING,
    correlationId=_STRING,
    legacyMessageId=_STRING,
    order=_record(
        orderId=_STRING,
        orderType=_STRING,
        channel=_STRING,
        storeId=_STRING,
        customerId=_STRING,
        orderedAt=_STRING,
        promisedDate=_STRING,
        currency=_STRING,
        totalAmount=_DOUBLE,
        lines=T.ArrayType(_record(
            lineNumber=_INT,
            sku=_STRING,
            quantity=_INT,
            unitPrice=_DOUBLE,
            fulfillmentType=_STRING,
            alteration=_record(
                type=_STRING,
                measurementInches=_DOUBLE,
                tailorShopId=_STRING,
            ),
        )),
        rental=_record(
            eventId=_STRING,
            eventDate=_STRING,
            returnDueDate=_STRING,
            groupId=_STRING,
        ),
        shipTo=_record(
            name=_STRING,
            line1=_STRING,
            line2=_STRING,
            city=_STRING,
            state=_STRING,
            postalCode=_STRING,
            country=_STRING,
        ),
    ),
)

INVENTORY_EVENT = _record(
    eventId=_STRING,
    eventType=_STRING,
    eventTime=_STRING,
    schemaVersion=_STRING,
    source=_STRING,
    correlationId=_STRING,
    orderId=_STRING,
    storeId=_STRING,
    lines=T.ArrayType(_record(
        lineNumber=_INT,
        sku=_STRING,
        quantity=_INT,
        status=_STRING,
        locationId=_STRING,
    )),
)

SHIPMENT_EVENT = _record(
    eventId=_STRING,
    eventType=_STRING,
    eventTime=_STRING,
    schemaVersion=_STRING,
    source=_STRING,
    correlationId=_STRING,
    orderId=_STRING,
    trackingNumber=_STRING,
    carrier=_STRING,
    status=_STRING,
    statusTime=_STRING,
    location=_STRING,
)

STORE_REFERENCE = _record(
    store_id=_STRING,
    store_name=_STRING,
    region=_STRING,
    timezone=_STRING,
)

LEGACY_ORDER = _record(
    order_nbr=_STRING,
    order_type=_STRING,
    store_nbr=_STRING,
    cust_nbr=_STRING,
    order_date=_STRING,
    total_amount=_DOUBLE,
    lines=T.ArrayType(_record(
        line_nbr=_INT,
        sku=_STRING,
        qty=_INT,
        price=_DOUBLE,
        fulfill_type=_STRING,
    )),
    source_file=_STRING,
    position=_INT,
)

# Fixed values of the event contract.
ORDER_CREATED = "ORDER_CREATED"
ORDER_EVENT_TYPES = ("ORDER_CREATED", "ORDER_UPDATED", "ORDER_CANCELLED")
ORDER_SOURCES = ("ORDER_INTAKE_API", "LEGACY_SOAP_ADAPTER", "TIBCO_EMS_BRIDGE", "REPLAY")
ORDER_TYPES = ("RETAIL", "TAILORED", "CUSTOM", "RENTAL", "ECOM")
RENTAL = "RENTAL"
ALTERATION = "ALTERATION"
INVENTORY_EVENT_TYPES = ("INVENTORY_RESERVED", "INVENTORY_BACKORDERED", "INVENTORY_RELEASED")
INVENTORY_LINE_STATUSES = ("RESERVED", "BACKORDERED", "RELEASED")
SHIPMENT_EVENT_TYPES = ("SHIPMENT_CREATED", "SHIPMENT_UPDATED")
SHIPMENT_STATUSES = (
    "LABEL_CREATED",
    "IN_TRANSIT",
    "OUT_FOR_DELIVERY",
    "DELIVERED",
    "EXCEPTION",
)
STAGE_PARSE = "PARSE"
STAGE_VALIDATE = "VALIDATE"
STAGE_WRITE = "BIGQUERY_WRITE"
REJECTED_TOPIC_PREFIX = "bigquery:"
REJECTED_TABLE_ATTRIBUTE = "bigQueryTable"
TOPICS = {"orders": "orders-v1", "inventory": "inventory-v1", "shipments": "shipments-v1"}
MATCH = "MATCH"
MISSING_IN_PUBSUB = "MISSING_IN_PUBSUB"
MISSING_IN_LEGACY = "MISSING_IN_LEGACY"
AMOUNT_MISMATCH = "AMOUNT_MISMATCH"
LINE_COUNT_MISMATCH = "LINE_COUNT_MISMATCH"
CLASSIFICATIONS = (
    MATCH,
    MISSING_IN_PUBSUB,
    MISSING_IN_LEGACY,
    AMOUNT_MISMATCH,
    LINE_COUNT_MISMATCH,
)

EVENTS = {"orders": ORDER_EVENT, "inventory": INVENTORY_EVENT, "shipments": SHIPMENT_EVENT}

# --------------------------------------------------------------------------- tables out


@dataclass(frozen=True)
class Table:
    """One output table: typed columns, columns that may not be null, and its layout.

    ``day_of`` is the column whose UTC day partitions the table (``day`` names the partition
    column); ``cluster_by`` is the column files are sorted on.
    """

    name: str
    schema: T.StructType
    required: tuple[str, ...]
    day_of: str | None
    day: str
    cluster_by: str | None


def _required(kind: T.DataType) -> tuple[T.DataType]:
    return (kind,)


def _table(name, day_of, day, cluster_by, columns: dict) -> Table:
    required = tuple(c for c, kind in columns.items() if isinstance(kind, tuple))
    schema = _record(**{c: kind[0] if isinstance(kind, tuple) else kind for c, kind in columns.items()})
    return Table(name, schema, required, day_of, day, cluster_by)


# Fixed values from here on: names, types and order of the tables' columns.
ORDER_EVENTS = _table(
    "order_events",
    "event_time",
    "event_date",
    "store_id",
    dict(
        event_id=_required(_STRING),
        event_type=_required(_STRING),
        event_time=_required(_TIME),
        schema_version=_STRING,
        source=_STRING,
        correlation_id=_STRING,
        legacy_message_id=_STRING,
        message_id=_STRING,
        publish_time=_TIME,
        order_id=_required(_STRING),
        order_type=_STRING,
        channel=_STRING,
        store_id=_required(_STRING),
        store_name=_STRING,
        region=_STRING,
        customer_id=_STRING,
        ordered_at=_TIME,
        promised_date=_DATE,
        currency=_STRING,
        total_amount=_DOUBLE,
        line_count=_LONG,
        alteration_line_count=_LONG,
        is_rental=_BOOL,
        lines=T.ArrayType(_record(
            line_number=_LONG,
            sku=_STRING,
            quantity=_LONG,
            unit_price=_DOUBLE,
            fulfillment_type=_STRING,
            alteration_type=_STRING,
            alteration_measurement_inches=_DOUBLE,
            tailor_shop_id=_STRING,
        )),
        rental_json=_STRING,
        ship_to_json=_STRING,
        ingested_at=_TIME,
    ),
)

ORDER_LINES = _table(
    "order_lines",
    "event_time",
    "event_date",
    "sku",
    dict(
        event_id=_required(_STRING),
        event_type=_required(_STRING),
        event_time=_required(_TIME),
        order_id=_required(_STRING),
        order_type=_STRING,
        channel=_STRING,
        store_id=_required(_STRING),
        region=_STRING,
        line_number=_required(_LONG),
        sku=_required(_STRING),
        quantity=_LONG,
        unit_price=_DOUBLE,
        line_amount=_DOUBLE,
        fulfillment_type=_STRING,
        alteration_type=_STRING,
        alteration_measurement_inches=_DOUBLE,
        tailor_shop_id=_STRING,
        ingested_at=_TIME,
    ),
)

INVENTORY_EVENTS = _table(
    "inventory_events",
    "event_time",
    "event_date",
    "store_id",
    dict(
        event_id=_required(_STRING),
        event_type=_required(_STRING),
        event_time=_required(_TIME),
        schema_version=_STRING,
        source=_STRING,
        correlation_id=_STRING,
        message_id=_STRING,
        publish_time=_TIME,
        order_id=_required(_STRING),
        store_id=_required(_STRING),
        line_count=_LONG,
        lines=T.ArrayType(_record(
            line_number=_LONG,
            sku=_STRING,
            quantity=_LONG,
            status=_STRING,
            location_id=_STRING,
        )),
        ingested_at=_TIME,
    ),
)

SHIPMENT_EVENTS = _table(
    "shipment_events",
    "event_time",
    "event_date",
    "order_id",
    dict(
        event_id=_required(_STRING),
        event_type=_required(_STRING),
        event_time=_required(_TIME),
        schema_version=_STRING,
        source=_STRING,
        correlation_id=_STRING,
        message_id=_STRING,
        publish_time=_TIME,
        order_id=_required(_STRING),
        tracking_number=_STRING,
        carrier=_STRING,
        status=_required(_STRING),
        status_time=_TIME,
        location=_STRING,
        ingested_at=_TIME,
    ),
)

STORE_ORDER_METRICS = _table(
    "store_order_metrics",
    "window_start",
    "window_date",
    "store_id",
    dict(
        store_id=_required(_STRING),
        window_start=_required(_TIME),
        window_end=_required(_TIME),
        pane_timing=_required(_STRING),
        pane_index=_LONG,
        is_last=_BOOL,
        orders=_required(_LONG),
        revenue=_required(_DOUBLE),
        alteration_lines=_required(_LONG),
        rental_orders=_required(_LONG),
        emitted_at=_TIME,
    ),
)

DEAD_LETTER = _table(
    "dead_letter",
    None,
    "ingest_date",
    None,
    dict(
        original_topic=_required(_STRING),
        stage=_required(_STRING),
        reason=_required(_STRING),
        message_id=_STRING,
        payload=_STRING,
        attributes_json=_STRING,
        failed_at=_required(_TIME),
    ),
)

LEGACY_OMS_ORDERS = _table(
    "legacy_oms_orders",
    "extract_date",
    "extract_day",
    "store_nbr",
    dict(
        extract_date=_required(_DATE),
        extract_file=_STRING,
        order_nbr=_required(_STRING),
        order_type=_STRING,
        store_nbr=_STRING,
        cust_nbr=_STRING,
        order_date=_STRING,
        total_amount=_DOUBLE,
        line_count=_LONG,
        lines=T.ArrayType(_record(
            line_nbr=_LONG,
            sku=_STRING,
            qty=_LONG,
            price=_DOUBLE,
            fulfill_type=_STRING,
        )),
        loaded_at=_TIME,
    ),
)

ORDER_RECONCILIATION = _table(
    "order_reconciliation",
    "run_date",
    "run_day",
    "classification",
    dict(
        run_date=_required(_DATE),
        run_id=_STRING,
        order_id=_required(_STRING),
        classification=_required(_STRING),
        legacy_total=_DOUBLE,
        pubsub_total=_DOUBLE,
        amount_diff=_DOUBLE,
        legacy_line_count=_LONG,
        pubsub_line_count=_LONG,
        legacy_store=_STRING,
        pubsub_store=_STRING,
        detail=_STRING,
        checked_at=_TIME,
    ),
)

TABLES = {
    t.name: t
    for t in (
        ORDER_EVENTS,
        ORDER_LINES,
        INVENTORY_EVENTS,
        SHIPMENT_EVENTS,
        STORE_ORDER_METRICS,
        DEAD_LETTER,
        LEGACY_OMS_ORDERS,
        ORDER_RECONCILIATION,
    )
}
