"""Small inputs shared by the tests."""

from __future__ import annotations

import datetime
import json

BASE = datetime.datetime(2026, 10, 3, 22, 0, 0)


def order_line(number=1, sku="MAIN", quantity=1, price=10.0, kind="STORE_PICKUP", **extra):
    return {
        "lineNumber": number,
        "sku": sku,
        "quantity": quantity,
        "unitPrice": price,
        "fulfillmentType": kind,
        **extra,
    }


def hem(number):
    return order_line(
        number,
        f"HEM-{number}",
        1,
        0.0,
        "ALTERATION",
        alteration={"type": "HEM", "measurementInches": 31.5, "tailorShopId": "T1"},
    )


def order_event(order_id="O-1", store="0412", total=10.0, order_type="RETAIL", lines=None, rental=None, **top):
    order = {
        "orderId": order_id,
        "orderType": order_type,
        "channel": "STORE",
        "storeId": store,
        "customerId": "C-1",
        "orderedAt": "2026-10-03T22:00:00Z",
        "promisedDate": "2026-10-10",
        "currency": "USD",
        "totalAmount": total,
        "lines": [order_line(price=total)] if lines is None else lines,
    }
    if rental:
        order["rental"] = {"eventId": "W-1", "eventDate": "2026-10-18", "returnDueDate": "2026-10-20"}
    event = {
        "eventId": f"evt-{order_id}",
        "eventType": "ORDER_CREATED",
        "eventTime": "2026-10-03T22:00:00Z",
        "schemaVersion": "1",
        "source": "ORDER_INTAKE_API",
        "correlationId": f"corr-{order_id}",
        "legacyMessageId": None,
        "order": order,
    }
    event.update(top)
    return event


def message(payload, number=0, seconds=0, attributes=None):
    text = payload if payload is None or isinstance(payload, str) else json.dumps(payload)
    return (f"m-{number}", BASE + datetime.timedelta(seconds=seconds), attributes, text)


def messages(spark, *payloads):
    from orderflow.schemas import MESSAGE

    rows = [p if isinstance(p, tuple) else message(p, i) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, MESSAGE)


def legacy_order(number, store, lines, extra=""):
    rows = "".join(
        f"<Line><LineNbr>{n}</LineNbr><SKU>P{n}{number}</SKU><Qty>{qty}</Qty><Price>{price}</Price></Line>"
        for n, (qty, price) in enumerate(lines, 1)
    )
    return f"<Order><OrderNbr>K-{number}</OrderNbr><StoreNbr>{store}</StoreNbr>{extra}<Lines>{rows}</Lines></Order>"


#: Five orders: two that agree with LANDED, another total, no event that can be read, another line count.
LEGACY_XML = (
    '<?xml version="1.0"?>\n<x:Orders xmlns:x="urn:own">'
    + legacy_order(901, "0031", [(3, "12.25"), (1, "8")], "<OrderType>CUSTOM</OrderType><CustNbr>Q4</CustNbr>")
    + legacy_order(902, "0031", [(1, "1.1")], "<TotalAmt>75.2</TotalAmt>")
    + legacy_order(903, "0042", [(4, "2.5")])
    + legacy_order(904, "0055", [(1, "6"), (2, "4.5")])
    + legacy_order(905, "0055", [(7, "3")])
    + "</x:Orders>\n"
)


def landed_row(number, total, count, kind="ORDER_CREATED", store="0031"):
    return {
        "event_id": f"{kind.lower()}-{number}",
        "event_type": kind,
        "event_time": f"2025-03-08T06:{number % 60:02d}:00.000Z",
        "order_id": f"K-{number}",
        "store_id": store,
        "total_amount": total,
        "line_count": count,
    }


LANDED = [
    landed_row(905, 21.0, 1, store="0055"),
    landed_row(901, 44.75, 2),
    landed_row(902, 70.0, 1),
    landed_row(903, "abc", 1, store="0042"),
    landed_row(904, 15.0, 5, store="0055"),
    landed_row(990, 33.3, 1),
    landed_row(991, 0.5, 1),
    landed_row(992, 8.0, 1, kind="ORDER_CANCELLED"),
]


def write_reconciliation_input(folder):
    (folder / "legacy").mkdir()
    (folder / "legacy" / "extract.xml").write_text(LEGACY_XML)
    lines = [json.dumps(row) for row in LANDED]
    lines[4:4] = ["{broken", ""]
    (folder / "order_events.jsonl").write_text("\n".join(lines))
