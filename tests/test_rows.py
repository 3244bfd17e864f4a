import datetime
import json

import pytest
from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.operators import counters, deadletter, enrich, parse
from orderflow.operators.skew import lookup_join
from orderflow.sinks.files import json_rows
from orderflow.sources import read_store_reference, store_reference_from_lines
from tests.samples import hem, message, messages, order_event, order_line

def now():
    return F.lit(datetime.datetime(2026, 10, 4, tzinfo=datetime.timezone.utc))


def enriched(spark, *events):
    lines = ["store_id,store_name,region,timezone", "0412,Ann's & Co,WEST,America/Los_Angeles", "  ", "0077,Other"]
    stores = store_reference_from_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    valid = parse.valid_of(parse.validate(messages(spark, *events), "orders"))
    return enrich.enrich_with_store(valid, stores)


def test_order_event_row(spark):
    event = order_event("O-1", total=312.05, lines=[order_line(price=280.5), hem(2)], rental=True)
    event["order"]["shipTo"] = {"name": "A", "country": "US", "planet": "Earth"}
    rows = enrich.to_order_events(enriched(spark, message(event, 1, 5)), now())
    assert rows.columns == S.ORDER_EVENTS.schema.names
    row = rows.first()
    assert (row["line_count"], row["alteration_line_count"], row["is_rental"]) == (2, 1, True)
    assert (row["store_name"], row["region"]) == ("Ann's & Co", "WEST")
    assert row["lines"][1]["alteration_type"] == "HEM" and row["lines"][0]["alteration_type"] is None
    assert json.loads(row["ship_to_json"]) == {"name": "A", "country": "US"}
    assert json.loads(row["rental_json"]) == {
        "eventId": "W-1",
        "eventDate": "2026-10-18",
        "returnDueDate": "2026-10-20",
    }
    assert row["publish_time"] == datetime.datetime(2026, 10, 3, 22, 0, 5)
    texts = json_rows(rows).first()
    assert texts["publish_time"] == "2026-10-03T22:00:05Z" and texts["ingested_at"] == "2026-10-04T00:00:00Z"


def test_order_without_lines_has_a_row_but_no_line_rows(spark):
    event = order_event(total=0, lines=[], eventType="ORDER_CANCELLED")
    del event["order"]["lines"]
    frame = enriched(spark, event)
    assert enrich.to_order_events(frame, now()).first()["lines"] == []
    assert enrich.to_order_lines(frame, now()).count() == 0


def test_order_line_rows(spark):
    event = order_event(lines=[order_line(quantity=3, price=2.5), hem(2)])
    rows = enrich.to_order_lines(enriched(spark, event), now())
    assert rows.columns == S.ORDER_LINES.schema.names
    first, second = rows.orderBy("line_number").collect()
    assert (first["line_amount"], second["tailor_shop_id"], first["region"]) == (7.5, "T1", "WEST")


def test_unknown_store_gives_nulls_and_is_counted(spark):
    frame = enriched(spark, order_event(), order_event("O-2", store="9999"), order_event("O-3", store="0077"))
    counted, seen = counters.count_enriched(frame)
    rows = {r["event"]["order"]["storeId"]: r for r in counted.collect()}
    assert rows["9999"]["store_name"] is None and rows["0077"]["region"] is None
    assert seen.get == {"enriched": 2, "store_not_found": 1}


def test_store_reference_file(spark, tmp_path):
    file = tmp_path / "stores.csv"
    file.write_text("Store_ID,n\n 0412 , A ,W, T \n\n,x\nlonely\n7,B\n")
    rows = read_store_reference(spark, str(file)).orderBy("store_id").collect()
    assert [tuple(r) for r in rows] == [("0412", "A", "W", "T"), ("7", "B", None, None)]
    assert read_store_reference(spark, None).count() == 0
    file.write_text("1,A\n1,B\n")
    with pytest.raises(ValueError, match="more than once"):
        read_store_reference(spark, str(file))


def test_lookup_beyond_the_broadcast_bound_is_salted_and_whole(spark):
    facts = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"), "id"
    )
    dim = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    dim = dim.unionByName(spark.createDataFrame([("hot", -1)], "k string, v long"))
    salted = lookup_join(facts, dim, "k", ["id"], rows=10, salts=4)
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan.split("Initial Plan")[0] or "_salt" in plan
    plain = facts.join(dim, "k", "left")
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.select(*salted.columns).collect()))


def test_dead_letter_row_and_message(spark):
    df = messages(spark, message("{bad", 1, 0, {"storeId": "1", "dlqStage": "old"}), message(None, None, 0, None))
    dead = parse.dead_of(parse.validate(df, "orders"), "orders-v1", now())
    rows = deadletter.to_dead_letter_rows(dead)
    assert rows.columns == S.DEAD_LETTER.schema.names
    by_payload = {r["payload"]: r for r in rows.collect()}
    assert json.loads(by_payload["{bad"]["attributes_json"]) == {"storeId": "1", "dlqStage": "old"}
    assert by_payload[""]["attributes_json"] == "{}"
    sent = {r["payload"]: r["attributes"] for r in deadletter.to_dlq_messages(dead).collect()}
    assert sent["{bad"]["storeId"] == "1" and sent["{bad"]["dlqStage"] == "PARSE"
    assert sent["{bad"]["originalMessageId"] == "m-1"
    assert sent["{bad"]["dlqFailedAt"] == "2026-10-04T00:00:00Z"
    assert sent[""]["originalTopic"] == "orders-v1"


def test_refused_rows_become_dead_letters(spark):
    good = enrich.to_order_events(enriched(spark, order_event()), now())
    late_year = good.withColumn("event_time", F.lit("+12026-10-03T22:00:00Z"))
    no_store = good.withColumn("store_id", F.lit(None).cast("string"))
    rows = good.unionByName(late_year).unionByName(no_store)
    accepted, dead = deadletter.conform(rows, S.ORDER_EVENTS, now())
    assert accepted.schema.names == S.ORDER_EVENTS.schema.names
    assert [f.dataType for f in accepted.schema] == [f.dataType for f in S.ORDER_EVENTS.schema]
    assert accepted.count() == 1
    refused = dead.orderBy("reason").collect()
    assert [r["reason"] for r in refused] == [
        "column event_time is no timestamp: '+12026-10-03T22:00:00Z'",
        "missing required column store_id",
    ]
    assert refused[0]["original_topic"] == "bigquery:order_events" and refused[0]["stage"] == "BIGQUERY_WRITE"
    assert refused[0]["attributes"] == {"bigQueryTable": "order_events"} and refused[0]["message_id"] is None
    payload = json.loads(refused[1]["payload"])
    assert payload["event_id"] == "evt-O-1" and "store_id" not in payload


def test_dead_letter_reports(spark):
    rows = spark.createDataFrame(
        [
            ("orders-v1", "PARSE", "x" * 100, datetime.datetime(2026, 10, 4, 1)),
            ("orders-v1", "PARSE", "x" * 90, datetime.datetime(2026, 10, 4, 2)),
            ("orders-v1", "VALIDATE", "y", datetime.datetime(2026, 10, 4, 3)),
            ("orders-v1", "VALIDATE", "y", datetime.datetime(2026, 10, 2, 3)),
        ],
        "original_topic string, stage string, reason string, failed_at timestamp",
    )
    noon = F.lit(datetime.datetime(2026, 10, 4, 12))
    assert [tuple(r) for r in deadletter.dead_letter_top_reasons(rows, noon).collect()] == [
        ("orders-v1", "PARSE", "x" * 80, 2),
        ("orders-v1", "VALIDATE", "y", 1),
    ]
    assert deadletter.dead_letter_counts(rows).where("reason = 'y'").first()["count"] == 2
