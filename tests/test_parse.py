import copy
import json

import pytest
from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.operators import counters, parse, rules
from tests.samples import hem, message, messages, order_event, order_line


def verdict(spark, payload, kind="orders"):
    row = parse.validate(messages(spark, payload), kind).first()
    return row["stage"], row["reason"], row["event"]


def changed(event, path, value):
    event = copy.deepcopy(event)
    *parents, last = path
    target = event
    for key in parents:
        target = target[key]
    target[last] = value
    return event


def test_valid_message_keeps_its_delivery_data(spark):
    df = messages(spark, message(order_event(), 7, 5, {"storeId": "0412"}))
    valid, dead = parse.split_valid(parse.validate(df, "orders"), "orders-v1")
    row = valid.first()
    assert row["message_id"] == "m-7" and row["attributes"] == {"storeId": "0412"}
    assert row["event"]["order"]["totalAmount"] == 10.0
    assert dead.count() == 0


def test_every_message_lands_on_exactly_one_side(spark):
    df = messages(spark, order_event(), "[1, {", "null", "", {"eventType": "ORDER_CREATED"}, order_event("O-2"))
    judged = parse.validate(df, "orders")
    counted, seen = counters.count_parsed(judged, "orders-test")
    valid, dead = parse.split_valid(counted, "orders-v1")
    assert valid.count() == 2
    assert seen.get == {"parsed": 2, "invalid": 4}
    rows = {r["message_id"]: r for r in dead.collect()}
    assert set(rows) == {"m-1", "m-2", "m-3", "m-4"}
    assert rows["m-1"]["payload"] == "[1, {" and rows["m-1"]["stage"] == "PARSE"
    assert rows["m-2"]["reason"] == "empty payload"
    assert rows["m-3"]["reason"].startswith("JSON parse error: ")
    assert all(r["original_topic"] == "orders-v1" for r in rows.values())


def test_all_problems_are_reported_together(spark):
    event = order_event(total=-0.25, lines=[])
    del event["order"]["channel"]
    stage, reason, _ = verdict(spark, event)
    assert stage == "VALIDATE"
    assert reason == (
        "order.channel is required; order.totalAmount must be >= 0, got -0.25; "
        "order.lines must not be empty for ORDER_CREATED"
    )


def test_unknown_enum_names_the_value(spark):
    stage, reason, _ = verdict(spark, order_event(eventType="ORDER_PLACED"))
    assert (stage, reason) == (
        "VALIDATE",
        "eventType 'ORDER_PLACED' not in [ORDER_CANCELLED, ORDER_CREATED, ORDER_UPDATED]",
    )


def test_cancelled_order_may_be_empty(spark):
    assert verdict(spark, order_event(total=0, lines=[], eventType="ORDER_CANCELLED"))[0] is None


def test_missing_order_stops_the_list(spark):
    stage, reason, _ = verdict(spark, {"eventType": "ORDER_CREATED"})
    assert stage == "VALIDATE"
    assert reason.startswith("eventId is required; eventTime must be an RFC-3339 timestamp, got 'null'")
    assert reason.endswith("order is required")


@pytest.mark.parametrize(
    "line, problem",
    [
        (None, "order.lines[0]. is null"),
        (order_line(number=0), "order.lines[0].lineNumber must be >= 1"),
        (order_line(sku=" "), "order.lines[0].sku is required"),
        (order_line(quantity=None), "order.lines[0].quantity must be >= 1"),
        (order_line(price=-0.01), "order.lines[0].unitPrice must be >= 0"),
        (order_line(kind=""), "order.lines[0].fulfillmentType is required"),
        (
            order_line(kind="ALTERATION"),
            "order.lines[0].alteration block is required when fulfillmentType == ALTERATION",
        ),
    ],
)
def test_line_rules(spark, line, problem):
    assert verdict(spark, order_event(lines=[line, hem(2)]))[:2] == ("VALIDATE", problem)


@pytest.mark.parametrize(
    "path, value, problem",
    [
        (["schemaVersion"], "", "schemaVersion is required"),
        (["source"], None, "source is required"),
        (["source"], "FAX", "source 'FAX' not in [LEGACY_SOAP_ADAPTER, ORDER_INTAKE_API, REPLAY, TIBCO_EMS_BRIDGE]"),
        (["eventTime"], "2026-10-03 22:00:00Z", "eventTime must be an RFC-3339 timestamp, got '2026-10-03 22:00:00Z'"),
        (["order", "orderType"], "GIFT", "order.orderType 'GIFT' not in [CUSTOM, ECOM, RENTAL, RETAIL, TAILORED]"),
        (["order", "channel"], "\t", "order.channel is required"),
        (["order", "currency"], None, "order.currency is required"),
        (["order", "totalAmount"], None, "order.totalAmount is required"),
        (["order", "orderedAt"], "2026-10-03", "order.orderedAt must be an RFC-3339 timestamp"),
        (["order", "promisedDate"], "2026-02-30", "order.promisedDate must be an ISO date (yyyy-MM-dd)"),
        (["order", "orderId"], "", "order.orderId is required"),
    ],
)
def test_header_rules(spark, path, value, problem):
    assert verdict(spark, changed(order_event(), path, value))[:2] == ("VALIDATE", problem)


def test_numbers_are_read_leniently(spark):
    for quoted in ("1.7", "1e1", "0x1"):
        refused = parse.validate(messages(spark, order_event(lines=[order_line(quantity=quoted)])), "orders").first()
        assert refused["stage"] == S.STAGE_PARSE
    blank = parse.validate(messages(spark, order_event(**{"source": "\u2003\x1c"})), "orders").first()
    assert blank["stage"] == S.STAGE_VALIDATE
    event = order_event(lines=[order_line(number="1", quantity=1.7, price="2.5")])
    event["order"]["totalAmount"] = "12.5"
    event["order"]["storeId"] = 412
    stage, _, read = verdict(spark, event)
    line = read["order"]["lines"][0]
    assert stage is None
    assert (line["lineNumber"], line["quantity"], line["unitPrice"]) == (1, 1, 2.5)
    assert read["order"]["totalAmount"] == 12.5 and read["order"]["storeId"] == "412"


@pytest.mark.parametrize(
    "payload",
    [
        '{"order": {"totalAmount": "ten"}}',
        '{"order": {"lines": [{"quantity": 3000000000}]}}',
        '{"order": {"lines": {"sku": "A"}}}',
        '{"order": "text"}',
        '{"eventId": {"a": 1}}',
        '{"order": {"lines": [{"sku": ["A"]}]}}',
        '{"order": {"totalAmount": NaN}}',
        "{'eventId': 'a'}",
        "[1]",
        "5",
        '"text"',
        '{"eventId": "a"',
        "   ",
    ],
)
def test_payloads_of_the_wrong_shape_do_not_parse(spark, payload):
    stage, reason, event = verdict(spark, payload)
    assert stage == "PARSE" and event is None
    assert reason.startswith("JSON parse error: ")


def test_text_that_only_looks_nested_is_text(spark):
    stage, _, event = verdict(spark, order_event(eventId="{not an object"))
    assert stage is None and event["eventId"] == "{not an object"


def test_unknown_fields_trailing_text_and_repeated_keys(spark):
    good = json.dumps(order_event())
    assert verdict(spark, good + " trailing")[0] is None
    assert verdict(spark, good[:-1] + ', "color": {"a": 1}}')[0] is None
    assert verdict(spark, good[:-1] + ', "eventId": "second"}')[2]["eventId"] == "second"


def test_reason_is_cut(spark):
    event = order_event(lines=[order_line(number=0, sku="") for _ in range(60)])
    reason = verdict(spark, event)[1]
    assert len(reason) == 1003 and reason.endswith("...")


def test_inventory_rules(spark):
    good = {
        "eventId": "i-1",
        "eventType": "INVENTORY_RESERVED",
        "eventTime": "2026-10-03T22:14:06.500Z",
        "orderId": "O-1",
        "storeId": "0412",
        "lines": [{"sku": "A", "quantity": 1, "status": "RESERVED"}],
    }
    assert verdict(spark, good, "inventory")[0] is None
    bad = {**good, "storeId": None, "lines": [None, {"sku": "", "quantity": 0, "status": "LOST"}]}
    assert verdict(spark, bad, "inventory")[1] == (
        "storeId is required; lines[0]. is null; lines[1].sku is required; "
        "lines[1].quantity must be >= 1; lines[1].status 'LOST' not in [BACKORDERED, RELEASED, RESERVED]"
    )
    assert verdict(spark, {**good, "lines": []}, "inventory")[1] == "lines must not be empty"


def test_shipment_rules(spark):
    good = {
        "eventId": "s-1",
        "eventType": "SHIPMENT_UPDATED",
        "eventTime": "2026-10-04T15:30:12.000Z",
        "orderId": "O-1",
        "trackingNumber": "1Z9",
        "carrier": "UPS",
        "status": "IN_TRANSIT",
        "statusTime": "2026-10-04T15:29Z",
    }
    assert verdict(spark, good, "shipments")[0] is None
    bad = {**good, "trackingNumber": "", "carrier": None, "status": "LOST", "statusTime": "soon"}
    assert verdict(spark, bad, "shipments")[1] == (
        "trackingNumber is required; carrier is required; status 'LOST' not in [DELIVERED, EXCEPTION, "
        "IN_TRANSIT, LABEL_CREATED, OUT_FOR_DELIVERY]; statusTime must be an RFC-3339 timestamp"
    )


def test_filter_does_not_repeat_the_parse(spark):
    """The plan of the valid side parses strictly once, plus the two conditional re-reads."""
    valid = parse.valid_of(parse.validate(messages(spark, order_event()), "orders"))
    plan = valid._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 3


def test_parse_events_alone(spark):
    rows = parse.parse_events(messages(spark, order_event(), "{"), "orders").orderBy("message_id").collect()
    assert rows[0]["parse_error"] is None and rows[0]["event"]["eventId"] == "evt-O-1"
    assert rows[1]["parse_error"].startswith("JSON parse error") and rows[1]["event"] is None


def test_schema_names(spark):
    event = parse.validate(messages(spark, order_event()), "orders").select("event.*")
    assert event.columns == S.ORDER_EVENT.names
    assert parse.validate(messages(spark, order_event()), "orders").where(F.col("stage").isNull()).count() == 1


def test_messages_are_copied_a_few_times_only(spark, capsys):
    """Each step of the parse copies payload and event; what odd payloads need is one column."""
    messages_once = messages(spark, order_event()).repartition(1)
    parse.validate(messages_once, "orders").explain()
    assert capsys.readouterr().out.count("Project [") <= 6


def test_lines_that_may_break_a_rule_are_never_taken_for_sound(spark):
    good = order_line() if callable(order_line) else order_line
    changes = [{"sku": v} for v in (None, "", " ", " ")] + [{"quantity": v} for v in (None, 0)]
    changes += [{"unitPrice": v} for v in (None, -0.5)] + [{"fulfillmentType": v} for v in (None, " ", S.ALTERATION)]
    changes += [{"lineNumber": None}, {"lineNumber": 0}]
    lists = [[good], [good, good]] + [[good, {**good, **change}] for change in changes] + [[good, None]]
    events = [changed(order_event(), ("order", "lines"), lines) for lines in lists]
    found = parse.parse_events(messages(spark, *events), "orders").orderBy("message_id")
    sound = F.coalesce(rules.order_lines_are_sound(F.col("event.order.lines")), F.lit(False))
    problems = rules.problem_text(F.col("event"), "orders") != ""
    rows = found.select(sound.alias("sound"), problems.alias("problems")).collect()
    assert sorted(r["sound"] for r in rows) == [False] * (len(lists) - 2) + [True] * 2
    assert all(r["sound"] != r["problems"] for r in rows)


@pytest.mark.parametrize("text, nested", [("a\n{b}", False), ("{b}", False), ({"b": 1}, True), ([1], True)])
def test_texts_of_lists_that_look_nested(spark, text, nested):
    event = changed(order_event(), ("order", "lines", 0, "sku"), text)
    stage, reason, _ = verdict(spark, event)
    assert (stage == "PARSE" and "nested value" in reason) if nested else stage is None
    row = messages(spark, event).select(F.from_json("payload", S.EVENTS["orders"]).alias("e"))
    assert row.select(parse._may_be_nested(F.col("e"), S.EVENTS["orders"]).alias("m")).first()["m"]
