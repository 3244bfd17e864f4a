"""Validation rules as pairs of columns: (condition, problem text)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.functions.text import is_blank, set_text
from orderflow.functions.times import is_iso_date, is_rfc3339

Rule = tuple[Column, Column]


def _required(value: Column, name: str, prefix: Column | None = None) -> Rule:
    return is_blank(value), _text(f"{name} is required", prefix)


def _text(message: str, prefix: Column | None) -> Column:
    return F.lit(message) if prefix is None else F.concat(prefix, F.lit(message))


def _one_of(value: Column, name: str, allowed: tuple[str, ...], prefix: Column | None = None) -> Rule:
    head = F.lit(f"{name} '") if prefix is None else F.concat(prefix, F.lit(f"{name} '"))
    text = F.concat(head, value, F.lit(f"' not in {set_text(allowed)}"))
    return ~is_blank(value) & ~value.isin(*allowed), text


def _event_time(value: Column) -> Rule:
    shown = F.coalesce(value, F.lit("null"))
    return ~is_rfc3339(value), F.concat(
        F.lit("eventTime must be an RFC-3339 timestamp, got '"), shown, F.lit("'")
    )


def _at_least(value: Column, least: int, name: str, prefix: Column) -> Rule:
    return value.isNull() | (value < least), _text(f"{name} must be >= {least}", prefix)


# The texts of the problems, and their order, are fixed values of the output.


def order_envelope_rules(e: Column) -> list[Rule]:
    return [
        _required(e["eventId"], "eventId"),
        _required(e["eventType"], "eventType"),
        _one_of(e["eventType"], "eventType", S.ORDER_EVENT_TYPES),
        _event_time(e["eventTime"]),
        _required(e["schemaVersion"], "schemaVersion"),
        _required(e["source"], "source"),
        _one_of(e["source"], "source", S.ORDER_SOURCES),
        (e["order"].isNull(), F.lit("order is required")),
    ]


def order_header_rules(e: Column) -> list[Rule]:
    """Rules that need the order block."""
    o = e["order"]
    return [
        _required(o["orderId"], "order.orderId"),
        _required(o["orderType"], "order.orderType"),
        _one_of(o["orderType"], "order.orderType", S.ORDER_TYPES),
        _required(o["channel"], "order.channel"),
        _required(o["storeId"], "order.storeId"),
        _required(o["currency"], "order.currency"),
        (o["totalAmount"].isNull(), F.lit("order.totalAmount is required")),
        (
            o["totalAmount"] < 0,
            F.concat(F.lit("order.totalAmount must be >= 0, got "), o["totalAmount"].cast("string")),
        ),
        (
            o["orderedAt"].isNotNull() & ~is_rfc3339(o["orderedAt"]),
            F.lit("order.orderedAt must be an RFC-3339 timestamp"),
        ),
        (
            o["promisedDate"].isNotNull() & ~is_iso_date(o["promisedDate"]),
            F.lit("order.promisedDate must be an ISO date (yyyy-MM-dd)"),
        ),
        (
            (e["eventType"] == S.ORDER_CREATED) & _is_empty(o["lines"]),
            F.lit("order.lines must not be empty for ORDER_CREATED"),
        ),
    ]


def order_line_rules(line: Column, prefix: Column) -> list[Rule]:
    altered = F.coalesce(line["fulfillmentType"] == S.ALTERATION, F.lit(False))
    return [
        _at_least(line["lineNumber"], 1, "lineNumber", prefix),
        _required(line["sku"], "sku", prefix),
        _at_least(line["quantity"], 1, "quantity", prefix),
        _at_least(line["unitPrice"], 0, "unitPrice", prefix),
        _required(line["fulfillmentType"], "fulfillmentType", prefix),
        (
            altered & line["alteration"].isNull(),
            _text("alteration block is required when fulfillmentType == ALTERATION", prefix),
        ),
    ]


def order_lines_are_sound(lines: Column) -> Column:
    """True only if no line breaks a rule; null or false if one may. Cheaper than the rules, which go line by line."""
    altered = F.exists(lines, lambda line: (line["fulfillmentType"] == S.ALTERATION) & line["alteration"].isNull())
    return (
        _all_at_least(lines["lineNumber"], 1)
        & _all_visible(lines["sku"])
        & _all_at_least(lines["quantity"], 1)
        & _all_at_least(lines["unitPrice"], 0)
        & _all_visible(lines["fulfillmentType"])
        & ~altered
    )


def inventory_rules(e: Column) -> list[Rule]:
    return [
        _required(e["eventId"], "eventId"),
        _required(e["eventType"], "eventType"),
        _one_of(e["eventType"], "eventType", S.INVENTORY_EVENT_TYPES),
        _event_time(e["eventTime"]),
        _required(e["orderId"], "orderId"),
        _required(e["storeId"], "storeId"),
        (_is_empty(e["lines"]), F.lit("lines must not be empty")),
    ]


def inventory_line_rules(line: Column, prefix: Column) -> list[Rule]:
    return [
        _required(line["sku"], "sku", prefix),
        _at_least(line["quantity"], 1, "quantity", prefix),
        _required(line["status"], "status", prefix),
        _one_of(line["status"], "status", S.INVENTORY_LINE_STATUSES, prefix),
    ]


def inventory_lines_are_sound(lines: Column) -> Column:
    """As ``order_lines_are_sound``."""
    allowed = F.array(*(F.lit(status) for status in S.INVENTORY_LINE_STATUSES))
    return (
        _all_visible(lines["sku"])
        & _all_at_least(lines["quantity"], 1)
        & (F.size(F.array_except(lines["status"], allowed)) == 0)
    )


def _all_at_least(numbers: Column, least: int) -> Column:
    # The smallest, or null if there is a null.
    return F.get(F.sort_array(numbers), F.lit(0)) >= least


def _all_visible(texts: Column) -> Column:
    """Whether all begin with a plain visible character (see ``is_blank``); null if there is a null."""
    return (F.get(F.sort_array(texts), F.lit(0)) >= "!") & (F.array_max(texts) < "\u1680")


def shipment_rules(e: Column) -> list[Rule]:
    return [
        _required(e["eventId"], "eventId"),
        _required(e["eventType"], "eventType"),
        _one_of(e["eventType"], "eventType", S.SHIPMENT_EVENT_TYPES),
        _event_time(e["eventTime"]),
        _required(e["orderId"], "orderId"),
        _required(e["trackingNumber"], "trackingNumber"),
        _required(e["carrier"], "carrier"),
        _required(e["status"], "status"),
        _one_of(e["status"], "status", S.SHIPMENT_STATUSES),
        (
            e["statusTime"].isNotNull() & ~is_rfc3339(e["statusTime"]),
            F.lit("statusTime must be an RFC-3339 timestamp"),
        ),
    ]


def problem_text(event: Column, kind: str) -> Column:
    """All problems of an event in rule order, joined by ``; ``; empty if there are none."""
    if kind == "orders":
        order = event["order"]
        header = _joined(
            order_header_rules(event), _line_text(order["lines"], "order.lines", order_line_rules, order_lines_are_sound)
        )
        inner = F.when(order.isNotNull() & (header != ""), header)
        return _joined(order_envelope_rules(event), inner)
    if kind == "inventory":
        lines = _line_text(event["lines"], "lines", inventory_line_rules, inventory_lines_are_sound)
        return _joined(inventory_rules(event), lines)
    if kind == "shipments":
        return _joined(shipment_rules(event))
    raise ValueError(f"no rules for '{kind}'")


def _is_empty(lines: Column) -> Column:
    return F.coalesce(F.size(lines), F.lit(0)) <= 0


def _joined(rules: list[Rule], *more: Column) -> Column:
    return F.concat_ws("; ", *(F.when(condition, text) for condition, text in rules), *more)


def _line_text(lines: Column, path: str, rules, are_sound) -> Column:
    """Problems of all lines, each prefixed with the line's 0-based place; null if there are none.

    Lines are first only tested, all at once, then one by one; texts are made for orders that have a faulty line.
    """

    def is_faulty(line: Column) -> Column:
        found = [condition for condition, _ in rules(line, F.lit(""))]
        return line.isNull() | reduce(lambda a, b: a | b, found)

    def of_line(line: Column, index: Column) -> Column:
        prefix = F.concat(F.lit(f"{path}["), index.cast("string"), F.lit("]."))
        text = F.when(line.isNull(), F.concat(prefix, F.lit(" is null"))).otherwise(
            _joined(rules(line, prefix))
        )
        return F.when(text != "", text)

    sound = F.coalesce(are_sound(lines), F.lit(False))
    faulty = ~sound & F.coalesce(F.exists(lines, is_faulty), F.lit(False))
    return F.when(faulty, F.array_join(F.transform(lines, of_line), "; "))
