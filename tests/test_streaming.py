import datetime
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.operators import metrics as M
from orderflow.operators import parse
from orderflow.operators.enrich import to_order_events
from orderflow.operators.events import dedupe_stream
from orderflow.sinks import append_stream
from orderflow.sinks.messages import to_kafka
from orderflow.sources import read_messages
from orderflow.streaming import jobs
from orderflow.streaming.jobs import OrdersBatch, StreamSettings, start_streams
from tests.samples import BASE, hem, message, messages, order_event, order_line


def seconds(time_):
    return int((time_ - BASE).total_seconds())


def test_rows_of_totals_so_far_and_of_complete_windows(spark):
    made = [("A", BASE + datetime.timedelta(seconds=t), float(a), 1, False) for t, a in ((1, 2), (50, 3), (61, 4))]
    created = spark.createDataFrame(
        made, "store_id string, publish_time timestamp, total_amount double, alteration_lines long, is_rental boolean"
    )
    clock = F.lit(BASE + datetime.timedelta(seconds=61))
    rows = M.running_rows(M.store_metrics_running(created), clock)
    assert rows.columns == S.STORE_ORDER_METRICS.schema.names
    columns = ("pane_timing", "pane_index", "is_last", "orders", "revenue")
    assert sorted(tuple(r[c] for c in columns) for r in rows.collect()) == [("EARLY", 0, False, 1, 4.0), ("LATE", 1, False, 2, 5.0)]
    final = M.final_rows(M.store_metrics_final(created))
    assert sorted(tuple(r[c] for c in columns) for r in final.collect()) == [("ON_TIME", 1, True, 1, 4.0), ("ON_TIME", 2, True, 2, 5.0)]


# ------------------------------------------------------------------ whole job


def put(folder, number, *rows):
    """One message file per batch; file times order the batches."""
    lines = [
        json.dumps(
            {
                "message_id": i,
                "publish_time": t.strftime("%Y-%m-%dT%H:%M:%S.000Z"),
                "attributes": a or {},
                "payload": p,
            }
        )
        for i, t, a, p in rows
    ]
    folder.mkdir(exist_ok=True)
    file = folder / f"{number:03d}.json"
    file.write_text("\n".join(lines))
    stamp = time.time() - 1000 + number
    os.utime(file, (stamp, stamp))


def sources(spark, tmp_path):
    for kind in ("orders", "inventory", "shipments"):
        (tmp_path / kind).mkdir(exist_ok=True)
    return [
        read_messages(spark, str(tmp_path / kind), fmt="json", stream=True, maxFilesPerTrigger="1")
        for kind in ("orders", "inventory", "shipments")
    ]


def run(spark, tmp_path, settings):
    stores = spark.createDataFrame([("0031", "North", "WEST", None)], S.STORE_REFERENCE)
    for query in start_streams(*sources(spark, tmp_path), stores, settings, available_now=True):
        query.awaitTermination()
        assert query.exception() is None


def feed(tmp_path):
    """Two stores over several minutes; one order arrives after the next window has begun."""
    orders = tmp_path / "orders"
    put(
        orders,
        0,
        message(order_event("P1", store="0031", total=25.5), 1, 5),
        message(order_event("P2", store="0031", total=80.0, order_type="RENTAL", rental=True), 2, 65),
        message("garbage", 3, 66),
        message(order_event("P3", store="0042", total=12.0, lines=[order_line(price=12.0), hem(2), hem(3)]), 4, 70),
    )
    put(
        orders,
        1,
        message(order_event("P4", store="0031", total=4.5), 5, 20),
        message(order_event("P4", store="0031", total=4.5, eventType="ORDER_CANCELLED"), 6, 150),
        message(order_event("P5", store="0042", total=1.0), 7, 200),
    )
    put(orders, 2, message(order_event("P6", store="0042", total=2.0), 8, 1000))
    put(orders, 3, message(order_event("P7", store="0042", total=3.0), 9, 1001))
    line = {"sku": "Z", "quantity": 2, "status": "RELEASED"}
    stamp = {"eventTime": "2025-03-08T06:31:00Z", "orderId": "P1"}
    released = {"eventId": "i-7", "eventType": "INVENTORY_RELEASED", "storeId": "0031", "lines": [line], **stamp}
    put(tmp_path / "inventory", 0, message(released, 1), message({"eventType": "INVENTORY_RELEASED"}, 2))
    shipped = {"eventId": "s-7", "eventType": "SHIPMENT_CREATED", "trackingNumber": "N", "carrier": "FEDEX", "status": "DELIVERED"}
    put(tmp_path / "shipments", 0, message({**shipped, **stamp}, 1))


def test_streaming_job(spark, tmp_path):
    feed(tmp_path)
    out = str(tmp_path / "out")
    settings = StreamSettings(out, str(tmp_path / "checkpoints"), dead_letters=str(tmp_path / "dlq"), early_seconds=1)
    run(spark, tmp_path, settings)
    assert settings.counts[("orders", 0)] == {
        "parsed": 3,
        "invalid": 1,
        "enriched": 2,
        "store_not_found": 1,
        "failed_inserts.order_events": 0,
        "failed_inserts.order_lines": 0,
    }
    # A restart goes on where the queries stopped.
    put(tmp_path / "orders", 4, message(order_event("P8", store="0031", total=9.0), 10, 1010))
    run(spark, tmp_path, settings)

    table = spark.read.parquet(f"{out}/store_order_metrics")
    shown = lambda rows: sorted(
        (r["store_id"], seconds(r["window_start"]), r["orders"], r["revenue"], r["alteration_lines"], r["rental_orders"]) for r in rows
    )
    ended = [("0031", 0, 1, 25.5, 0, 0), ("0031", 60, 1, 80.0, 0, 1), ("0042", 60, 1, 12.0, 2, 0), ("0042", 180, 1, 1.0, 0, 0)]
    assert shown(table.where("pane_timing = 'ON_TIME'").collect()) == ended
    panes = table.where("store_id = '0031' AND window_start = TIMESTAMP '2026-10-03 22:00:00'").orderBy("pane_index").collect()
    assert [(r["pane_timing"], r["pane_index"], r["orders"], r["revenue"]) for r in panes] == [
        ("EARLY", 0, 1, 25.5),
        ("ON_TIME", 1, 1, 25.5),
        ("LATE", 2, 2, 30.0),
    ]
    assert not table.where("is_last").count()

    # The last row of each window is what a batch over all orders gives.
    everything = read_messages(spark, str(tmp_path / "orders"), fmt="json")
    batch = M.store_metrics_final(M.created_by_store(parse.valid_of(parse.validate(everything, "orders"))))
    newest = table.groupBy("store_id", "window_start").agg(
        *(F.max_by(c, "pane_index").alias(c) for c in ("orders", "revenue", "alteration_lines", "rental_orders"))
    )
    assert shown(newest.collect()) == shown(batch.collect())

    counts = {t: spark.read.parquet(f"{out}/{t}").count() for t in list(S.TABLES)[:4] + ["dead_letter"]}
    assert counts["order_events"] == 9 and counts["order_lines"] == 11
    assert counts["inventory_events"] == counts["shipment_events"] == 1
    assert counts["dead_letter"] == 2 == spark.read.json(str(tmp_path / "dlq")).count()


def test_panes_of_late_orders(spark, tmp_path):
    """Each late order gives a total; what comes after the lateness is counted; a catch-up batch is not late."""
    orders = tmp_path / "orders"
    put(orders, 0, *(message(order_event(f"A{n}", store="0031", total=1.25), n, t) for n, t in enumerate((5, 6, 62, 130))))
    late = [message(order_event(f"B{n}", store="0031", total=2.0), 10 + n, 10 + n) for n in range(3)]
    put(orders, 1, *late, message(order_event("C", store="0055", total=7.0), 20, 30), message(order_event("D", store="0031"), 21, 70))
    put(orders, 2, message(order_event("E", store="0031", total=1.0), 30, 500))
    put(orders, 3, message(order_event("G", store="0031", total=1.0), 41, 510))
    put(orders, 4, *(message(order_event("F", store="0031", total=1.0), 50, t) for t in (8, 9)), message(order_event("H", store="0031", total=1.0), 51, 20_000))
    settings = StreamSettings(str(tmp_path / "out"), str(tmp_path / "c"), dead_letters=str(tmp_path / "dlq"))
    run(spark, tmp_path, settings)
    panes: dict = {}
    for r in spark.read.parquet(f"{tmp_path}/out/store_order_metrics").orderBy("pane_index").collect():
        own = panes.setdefault((r["store_id"], seconds(r["window_start"])), [])
        assert r["pane_index"] == len(own) and not r["is_last"]
        own.append((r["pane_timing"], r["orders"], r["revenue"]))
    assert panes[("0031", 0)] == [("EARLY", 2, 2.5), ("ON_TIME", 2, 2.5), ("LATE", 3, 4.5), ("LATE", 4, 6.5), ("LATE", 5, 8.5)]
    assert panes[("0055", 0)] == [("LATE", 1, 7.0)]
    assert [p[:2] for p in panes[("0031", 60)]] == [("EARLY", 1), ("ON_TIME", 1), ("LATE", 2)]
    assert [p[:2] for p in panes[("0031", 480)]] == [("EARLY", 1), ("EARLY", 2), ("ON_TIME", 2)]
    deadline = time.time() + 30
    while sum(c.get("dropped_late", 0) for c in settings.counts.values()) < 2 and time.time() < deadline:
        time.sleep(0.2)
    assert sum(c.get("dropped_late", 0) for (kind, _), c in settings.counts.items() if kind == "metrics") == 2


def test_repeated_messages_are_left_out(spark, tmp_path):
    put(tmp_path / "orders", 0, *(message(order_event("1", store="0031", total=3.0), 1, 5) for _ in range(3)))
    put(tmp_path / "orders", 1, message(order_event("1", store="0031", total=3.0), 1, 5), message(order_event("2", store="0031"), 2, 500))
    settings = StreamSettings(str(tmp_path / "out"), str(tmp_path / "c"), dead_letters=str(tmp_path / "dlq"), dedupe_minutes=10)
    run(spark, tmp_path, settings)
    assert spark.read.parquet(f"{tmp_path}/out/order_events").count() == 2
    panes = spark.read.parquet(f"{tmp_path}/out/store_order_metrics").where("revenue = 3.0").orderBy("pane_index").collect()
    assert [(r["pane_timing"], r["orders"]) for r in panes] == [("EARLY", 1), ("ON_TIME", 1)]


def test_counts_are_bounded(monkeypatch):
    monkeypatch.setattr(jobs, "COUNTED_BATCHES", 3)
    settings = StreamSettings("o", "c", jsonl=True)
    for n in range(9):
        settings.count("orders", n, {"parsed": n})
    assert list(settings.counts) == [("orders", 6), ("orders", 7), ("orders", 8)]


def test_dead_letters_to_a_topic(spark, tmp_path, monkeypatch):
    """No broker here: what is handed to the writer, and its columns for the connector."""
    sent = []
    monkeypatch.setattr(jobs, "write_messages", lambda rows, target, fmt, *a, **o: sent.append((to_kafka(rows).collect(), target, fmt, o)))
    settings = StreamSettings(
        str(tmp_path / "o"), str(tmp_path / "c"), dead_letters="dead", dead_letter_format="kafka", dead_letter_options={"x": "y"}
    )
    stores = spark.createDataFrame([], S.STORE_REFERENCE)
    OrdersBatch(stores, settings)(messages(spark, message("{", 2, 20)), 0)
    (rows, target, fmt, options), = sent
    assert (target, fmt, options) == ("dead", "kafka", {"x": "y"}) and bytes(rows[0]["value"]) == b"{"


def test_repeated_batch_writes_the_same(spark, tmp_path):
    """A batch that is attempted again replaces what its first attempt wrote."""
    settings = StreamSettings(str(tmp_path / "o"), str(tmp_path / "c"), dead_letters=str(tmp_path / "d"))
    batch = OrdersBatch(lambda: spark.createDataFrame([("1", "New", None, None)], S.STORE_REFERENCE), settings)
    first = messages(spark, message(order_event("1"), 1, 10), message("{", 2, 20))
    second = messages(spark, message(order_event("2"), 3, 30), message(order_event("3", store="1"), 4, 95))
    batch(first, 0)
    for _ in range(2):
        batch(second, 1)
    rows = spark.read.parquet(f"{tmp_path}/o/order_events").collect()
    assert sorted((r["order_id"], r["store_name"]) for r in rows) == [("1", None), ("2", None), ("3", "New")]
    assert spark.read.parquet(f"{tmp_path}/o/dead_letter").count() == 1


def test_json_lines_mode(spark, tmp_path):
    feed(tmp_path)
    out = tmp_path / "out"
    settings = StreamSettings(str(out), str(tmp_path / "checkpoints"), jsonl=True)
    run(spark, tmp_path, settings)
    lines = [json.loads(x) for p in out.glob("order_events/batch=*/part-*") for x in p.read_text().splitlines()]
    assert len(lines) == 8 and all("legacy_message_id" not in row for row in lines)
    third = next(row for row in lines if row["order_id"] == "P3")
    assert third["lines"][1]["alteration_type"] == "HEM"
    assert spark.read.json(str(out / "dead_letter")).count() == 2
    with pytest.raises(ValueError):
        StreamSettings("a", "b")


def test_streaming_sinks_and_operators(spark, tmp_path):
    """Final metrics, dedup within the watermark, and the one-table stream writer."""
    orders = tmp_path / "orders"
    put(orders, 0, message(order_event("1"), 1, 10), message(order_event("1"), 2, 12))
    put(orders, 1, message(order_event("2"), 3, 3600))
    put(orders, 2, message(order_event("3"), 4, 3700))
    stream = read_messages(spark, str(orders), fmt="json", stream=True, maxFilesPerTrigger="1")
    valid = parse.valid_of(parse.validate(stream, "orders"))

    final = M.store_metrics_final(M.created_by_store(valid))
    query = (
        final.writeStream.format("parquet").option("path", str(tmp_path / "final"))
        .option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert [(r["orders"], r["revenue"]) for r in spark.read.parquet(str(tmp_path / "final")).collect()] == [(2, 20.0)]

    plain = valid.withColumn("store_name", F.lit(None).cast("string")).withColumn("region", F.lit(None).cast("string"))
    keyed = plain.withColumn("event_id", F.col("event.eventId"))
    rows = to_order_events(dedupe_stream(keyed))
    typed = rows.select(*(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in S.ORDER_EVENTS.schema))
    for once, name in ((True, "exact"), (False, "atleast")):
        root = str(tmp_path / name)
        writer = append_stream(typed, S.ORDER_EVENTS, root, str(tmp_path / f"c-{name}"), exactly_once=once)
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        back = spark.read.parquet(f"{root}/order_events")
        assert sorted(r["order_id"] for r in back.collect()) == ["1", "2", "3"]
        assert "event_date" in back.columns
