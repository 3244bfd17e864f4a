import datetime
import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.functions import numbers as N
from orderflow.functions import times
from orderflow.operators import counters, events, parse, reconcile, revenue
from orderflow.operators import metrics as M
from orderflow.plans.backfill import backfill
from orderflow.plans.daily_reconciliation import ReconciliationSettings, daily_reconciliation
from orderflow.plans.store_revenue import store_revenue
from orderflow.sinks import append_table, write_csv_report, write_messages
from orderflow.sinks.messages import to_kafka
from orderflow.sinks.tables import replace_day, write_batch
from orderflow.sources import parse_legacy, read_legacy_extract, read_messages, read_order_events
from orderflow.sources.legacy import parse_legacy_files
from tests.samples import LEGACY_XML, messages, order_event, write_reconciliation_input


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


# ------------------------------------------------------------------ revenue


def test_revenue_skips_bad_lines(spark):
    csv = lines(
        spark,
        "order_id,store_id,amount",
        "a,0031,12.345",
        "b,\t0031\t,0.10",
        "c, 0042 , 7 ,more",
        "d,0042,x7",
        "e,0042",
        "f,,3",
        "  ",
        "g,0055,90000000000000000",
        "h,0055,1e30",
        "i,0055,NaN",
    )
    cents, seen = counters.count_lines(revenue.read_cents(csv))
    assert cents.count() == 9
    assert seen.get == {"parsed": 6, "skipped": 3}
    largest = 9000000000000000000 + 9223372036854775807
    assert {tuple(r) for r in revenue.revenue_per_store(csv).collect()} == {
        ("0031", "12.45"),
        ("0042", "7.00"),
        ("", "3.00"),
        ("0055", f"{largest // 100}.{largest % 100:02d}"),
    }


def test_cents_are_formatted_with_one_sign(spark):
    df = spark.createDataFrame([("-5.5",), ("-0.05",), ("0.005",), ("1e3",), ("NaN",)], "x string")
    shown = df.select(N.cents_text(N.to_cents(F.col("x")))).collect()
    assert [r[0] for r in shown] == ["-5.50", "-0.05", "0.01", "1000.00", None]


def test_revenue_job_writes_one_report(spark, tmp_path):
    source, target = tmp_path / "orders.csv", tmp_path / "report"
    source.write_text("order_id,store_id,amount\nA,1,2.50\nB,1,0.25\n")
    store_revenue(spark, str(source), str(target))
    parts = list(target.glob("part-*.csv"))
    assert len(parts) == 1 and parts[0].read_text() == "store_id,revenue\n1,2.75\n"


def test_money_sums_do_not_lose_values(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(1e25,), (None,)], "x double")
    assert df.where("x < 1").select(N.money_sum(F.col("x"))).first()[0] == 1.0
    assert df.select(N.money_sum(F.col("x"))).first()[0] == 1e25


# ------------------------------------------------------------------ legacy extract


def files(spark, *documents):
    rows = [(f"f{i}", d) for i, d in enumerate(documents)]
    return spark.createDataFrame(rows, "source_file string, value string")


def order_xml(inner):
    return f"<Orders><Order><OrderNbr>X-1</OrderNbr>{inner}</Order></Orders>"


def test_namespaced_extract(spark, tmp_path):
    (tmp_path / "a.xml").write_text(LEGACY_XML)
    orders = read_legacy_extract(spark, str(tmp_path / "*.xml")).orderBy("position").collect()
    assert [o["order_nbr"] for o in orders] == ["K-901", "K-902", "K-903", "K-904", "K-905"]
    first = orders[0]
    assert (first["order_type"], first["store_nbr"], first["cust_nbr"]) == ("CUSTOM", "0031", "Q4")
    assert first["lines"][1]["sku"] == "P2901" and first["total_amount"] is None
    rows = reconcile.to_legacy_rows(read_legacy_extract(spark, str(tmp_path / "*.xml")), "2025-03-08")
    assert rows.columns == S.LEGACY_OMS_ORDERS.schema.names
    totals = {r["order_nbr"]: r["total_amount"] for r in rows.collect()}
    assert totals == {"K-901": 44.75, "K-902": 75.2, "K-903": 10.0, "K-904": 15.0, "K-905": 21.0}


def test_no_files_means_no_orders(spark, tmp_path):
    assert read_legacy_extract(spark, str(tmp_path / "*.xml")).count() == 0


@pytest.mark.parametrize(
    "inner, total",
    [
        ("<TotalAmount>99.5</TotalAmount><Lines><Line><Qty>2</Qty><Price>10</Price></Line></Lines>", 99.5),
        ("<TotalAmt>7</TotalAmt>", 7.0),
        ("<TotalAmount/><TotalAmt>7</TotalAmt><Lines><Line><Qty>2</Qty><Price>10</Price></Line></Lines>", 20.0),
        ("<TotalAmount>1</TotalAmount><TotalAmount>2</TotalAmount>", 1.0),
        ("<Lines><Line><Qty/><Price>10</Price></Line></Lines>", 0.0),
        ("", 0.0),
    ],
)
def test_effective_total(spark, inner, total):
    orders = parse_legacy(files(spark, order_xml(inner)))
    assert orders.select(reconcile.effective_total(F.col("total_amount"), F.col("lines"))).first()[0] == total


def test_a_bad_file_is_refused_as_a_whole(spark):
    frame = files(
        spark,
        LEGACY_XML,
        "<Orders/>",
        order_xml("")[: -len("</Orders>")],
        "<!DOCTYPE Orders []>" + order_xml(""),
        order_xml("<Lines><Line><Qty>1.0</Qty></Line></Lines>"),
        order_xml("<TotalAmount>ten</TotalAmount>"),
        "no xml",
        "",
        order_xml("<TotalAmount>\n 5 \n</TotalAmount>"),
        "<?xml version='1.0'?><!-- <Orders> -->\n<!DOCTYPE Orders []>" + order_xml(""),
        "<!-- a -->" + order_xml("<!-- <!DOCTYPE a> --><!-- <Order/> <Line/> -->") + "<!-- b -->\n",
        "<Orders><Batch><Order><OrderNbr>1</OrderNbr></Order></Batch><Order><OrderNbr>2</OrderNbr></Order></Orders>",
        order_xml("<Line><Qty>1</Qty></Line>"),
        order_xml("") + "<more/>",
        order_xml("") + "text",
        order_xml("<CustNbr>a<b>c</b></CustNbr>"),
        order_xml("<CustNbr>&unknown;</CustNbr>"),
        "<x:Orders><Order/></x:Orders>",
    )
    counted, seen = counters.count_files(parse_legacy_files(frame))
    failed = {r["source_file"]: r["failed"] for r in counted.collect()}
    assert failed == {f"f{i}": i not in (0, 1, 8, 10, 11, 12, 15) for i in range(18)}
    assert seen.get == {"files_parsed": 7, "files_failed": 11, "orders_parsed": 11}
    assert parse_legacy(frame).count() == 11


def test_orders_and_lines_anywhere(spark):
    """Any root, any depth, orders within orders, and values with markup in them."""
    line = "<l:Line xmlns:l='urn:l'><LineNbr>%d</LineNbr><SKU>s</SKU></l:Line>"
    frame = files(
        spark,
        "<Extract>" + order_xml("") + "</Extract>",
        "<Root><Batch><Order><OrderNbr>1</OrderNbr></Order></Batch><Order><OrderNbr>2</OrderNbr></Order></Root>",
        "<Order><OrderNbr>1</OrderNbr>" + line % 1 + "<More><Deep>" + line % 2 + "</Deep></More></Order>",
        "<Order><OrderNbr>1</OrderNbr>" + line % 1 + "<Order><StoreNbr>9</StoreNbr>" + line % 2 + "</Order></Order>",
        "<Orders><Order><OrderNbr>a &lt;b&gt; c</OrderNbr><CustNbr>a<b>c</b> </CustNbr></Order></Orders>",
        "<Orders><Order><Info><OrderNbr>deep</OrderNbr></Info><OrderNbr/><OrderNbr>second</OrderNbr></Order></Orders>",
        "<Orders><Order><Qty>x</Qty><Line><TotalAmount>y</TotalAmount></Line></Order><Line/><OrderNbr>out</OrderNbr></Orders>",
        "<Orders><Order><OrderNbr><![CDATA[<Order>]]><!-- x --></OrderNbr></Order></Orders>",
    )
    got: dict = {}
    for r in parse_legacy(frame).orderBy("source_file", "position").collect():
        numbers = [line["line_nbr"] for line in r["lines"]]
        got.setdefault(r["source_file"], []).append((r["order_nbr"], r["store_nbr"], r["cust_nbr"], numbers))
    assert got == {
        "f0": [("X-1", None, None, [])],
        "f1": [("1", None, None, []), ("2", None, None, [])],
        "f2": [("1", None, None, [1, 2])],
        "f3": [("1", None, None, [1, 2]), (None, "9", None, [2])],
        "f4": [("a <b> c", None, "ac", [])],
        "f5": [("", None, None, [])],
        "f6": [(None, None, None, [None])],
        "f7": [("<Order>", None, None, [])],
    }


def test_encodings_of_files(spark, tmp_path):
    text = "<?xml version='1.0' encoding='%s'?>" + order_xml("<CustNbr>Zo\u00eb</CustNbr>")
    (tmp_path / "a.xml").write_bytes((text % "ISO-8859-1").encode("latin-1"))
    (tmp_path / "b.xml").write_bytes((text % "UTF-16").encode("utf-16"))
    (tmp_path / "c.xml").write_bytes((text % "UTF-8").encode("utf-8-sig"))
    (tmp_path / "d.xml").write_bytes((text % "UTF-8").encode("latin-1"))
    assert [r["cust_nbr"] for r in read_legacy_extract(spark, str(tmp_path / "*.xml")).collect()] == ["Zo\u00eb"] * 3
    assert read_legacy_extract(spark, str(tmp_path)).count() == 3


# ------------------------------------------------------------------ reconciliation


def test_daily_job_on_files(spark, tmp_path):
    write_reconciliation_input(tmp_path)
    out = tmp_path / "out"
    done = daily_reconciliation(
        spark,
        ReconciliationSettings(
            report=str(tmp_path / "report"),
            local_input=str(tmp_path),
            local_output=str(out),
            run_date="2025-03-08",
        ),
    )
    assert done.legacy.count() == 5
    found = {r["order_id"]: r for r in done.results.collect()}
    assert {k: r["classification"] for k, r in found.items()} == {
        "K-901": "MATCH",
        "K-902": "AMOUNT_MISMATCH",
        "K-903": "MISSING_IN_PUBSUB",
        "K-904": "LINE_COUNT_MISMATCH",
        "K-905": "MATCH",
        "K-990": "MISSING_IN_LEGACY",
        "K-991": "MISSING_IN_LEGACY",
    }
    assert found["K-902"]["amount_diff"] == pytest.approx(5.2)
    assert found["K-902"]["detail"] == "legacy total 75.20 vs pubsub total 70.00 (tolerance 0.01)"
    assert found["K-904"]["detail"] == "legacy lines 2 vs pubsub lines 5"
    assert found["K-990"]["legacy_total"] is None and found["K-990"]["pubsub_total"] == 33.3
    assert [r["reason"] for r in done.unreadable.collect()] == ["total or line count is no number, order K-903"]
    assert done.counts == {
        **{c: 1 for c in S.CLASSIFICATIONS},
        "MATCH": 2,
        "MISSING_IN_LEGACY": 2,
        "files_parsed": 1,
        "files_failed": 0,
        "orders_parsed": 5,
        "lines_read": 8,
        "lines_skipped": 1,
        "unreadable_events": 1,
    }
    report = next((tmp_path / "report").glob("part-*.csv")).read_text().splitlines()
    assert report[0] == "run_date,classification,count" and len(report) == 6

    def written(name):
        return [json.loads(x) for p in (out / name).glob("part-*") for x in p.read_text().splitlines()]

    assert len(written("legacy_oms_orders")) == 5 and written("legacy_oms_orders")[0]["extract_date"] == "2025-03-08"
    assert len(written("order_reconciliation")) == 7
    assert json.loads(written("dead_letter")[0]["payload"])["total_amount"] == "abc"


def test_daily_job_on_tables(spark, tmp_path):
    """Tables in, tables out; a blank order number is refused, and a second run wins."""
    (tmp_path / "legacy").mkdir()
    blank = "<Order><StoreNbr>1</StoreNbr></Order></x:Orders>"
    (tmp_path / "legacy" / "a.xml").write_text(LEGACY_XML.replace("</x:Orders>", blank))
    day = datetime.datetime(2025, 3, 8, 10)
    landed = spark.createDataFrame(
        [
            ("e1", "ORDER_CREATED", day, "K-905", "0055", 21.0, 1),
            ("e2", "ORDER_CREATED", day + datetime.timedelta(days=1), "K-902", "0031", 75.2, 1),
            ("e3", "ORDER_UPDATED", day, "K-903", "0042", 10.0, 1),
        ],
        "event_id string, event_type string, event_time timestamp, order_id string, store_id string, "
        "total_amount double, line_count long",
    )
    names = landed.columns
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in S.ORDER_EVENTS.schema if f.name not in names]
    append_table(landed.select("*", *missing), S.ORDER_EVENTS, str(tmp_path / "out"))
    for run in ("run-1", "run-2"):
        done = daily_reconciliation(
            spark,
            ReconciliationSettings(
                report=str(tmp_path / "report"),
                legacy_glob=str(tmp_path / "legacy" / "*.xml"),
                order_events=str(tmp_path / "out" / "order_events"),
                out=str(tmp_path / "out"),
                run_date="2025-03-08",
                run_id=run,
            ),
        )
        assert done.counts["MATCH"] == 1 and done.counts["MISSING_IN_PUBSUB"] == 4
        assert done.counts["failed_inserts.legacy_oms_orders"] == 1 and done.counts["orders_parsed"] == 6
    table = spark.read.parquet(str(tmp_path / "out" / "order_reconciliation"))
    assert table.count() == 10
    card = reconcile.daily_scorecard(table, "2025-03-08").collect()
    assert [(r["classification"], r["orders"]) for r in card] == [("MATCH", 1), ("MISSING_IN_PUBSUB", 4)]
    dead = spark.read.parquet(str(tmp_path / "out" / "dead_letter")).collect()
    assert {r["reason"] for r in dead} == {"missing required column order_nbr"} and len(dead) == 2
    scan = read_order_events(spark, str(tmp_path / "out" / "order_events"), "2025-03-08")
    assert "event_date" in scan._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:60]


def test_duplicates_collapse(spark):
    legacy = parse_legacy(
        files(
            spark,
            order_xml("<TotalAmount>1</TotalAmount>"),
            order_xml("<TotalAmount>2</TotalAmount>") ,
        )
    )
    rows = spark.createDataFrame(
        [
            ("X-1", "ORDER_CREATED", "2026-10-03T10:00:00Z", "5", 1),
            ("X-1", "ORDER_CREATED", "2026-10-03T11:00:00Z", "1", 0),
            ("X-1", "ORDER_CREATED", None, "9", 1),
            ("X-1", "ORDER_UPDATED", "2026-10-03T12:00:00Z", "9", 1),
            (" ", "ORDER_CREATED", None, "9", 1),
            ("X-2", None, None, "many", 1),
            ("X-3", None, None, None, None),
        ],
        "order_id string, event_type string, event_time string, total_amount string, line_count int",
    ).withColumn("store_id", F.lit("1"))
    found = {r["order_id"]: r for r in reconcile.reconcile(legacy, rows, "2026-10-03").collect()}
    assert set(found) == {"X-1", "X-3"} and found["X-1"]["classification"] == "MATCH"
    assert found["X-3"]["pubsub_total"] == 0.0 and found["X-3"]["pubsub_line_count"] == 0
    assert [r["order_id"] for r in reconcile.unreadable_events(rows).collect()] == ["X-2"]


def test_run_date():
    assert reconcile.resolve_run_date("2026-10-03") == "2026-10-03"
    yesterday = datetime.datetime.now(datetime.timezone.utc).date() - datetime.timedelta(days=1)
    assert reconcile.resolve_run_date(" ") == yesterday.isoformat()
    for bad in ("10/03/2026", "2026-1-3", "2026-02-30"):
        with pytest.raises(ValueError):
            reconcile.resolve_run_date(bad)


def test_reconciliation_shuffles_each_side_once(spark):
    legacy = parse_legacy(files(spark, LEGACY_XML))
    rows = spark.createDataFrame(
        [("X", "ORDER_CREATED", "t", 1.0, 1, "s")],
        "order_id string, event_type string, event_time string, total_amount double, line_count int, store_id string",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = reconcile.reconcile(legacy, rows, "2026-10-03")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2


# ------------------------------------------------------------------ tables, queries, functions


def test_final_metrics(spark):
    rows = spark.createDataFrame(
        [("A", 0.7, 4, True), ("A", 12.05, 0, True), ("B", None, 0, False), ("A", 30.0, 1, False), ("A", None, 0, False)],
        "store_id string, total_amount double, alteration_lines long, is_rental boolean",
    ).withColumn("publish_time", F.lit(datetime.datetime(2026, 10, 3, 22, 0, 30)))
    got = {r["store_id"]: r for r in M.store_metrics_final(rows).collect()}
    assert tuple(got["A"])[3:] == (4, 42.75, 5, 2)
    assert tuple(got["B"])[3:] == (1, 0.0, 0, 0)
    assert got["A"]["window_start"] == datetime.datetime(2026, 10, 3, 22, 0)


def test_metrics_on_business_time(spark):
    df = messages(spark, order_event("1", eventTime="2026-10-03T20:00Z"), order_event("2", eventTime="2026-10-03T20:00:59z"))
    created = M.created_by_store(parse.valid_of(parse.validate(df, "orders")))
    rows = M.store_metrics_final(created, time="event_time").collect()
    assert [(r["window_start"], r["orders"]) for r in rows] == [(datetime.datetime(2026, 10, 3, 20), 2)]


def test_backfill_writes_every_table(spark, tmp_path):
    stamp = {"eventTime": "2025-03-08T06:31:00+01:00", "orderId": "K-12"}
    held = [{"sku": f"P{n}", "quantity": n, "status": "BACKORDERED"} for n in (1, 7)]
    inventory = {"eventId": "i-40", "eventType": "INVENTORY_BACKORDERED", "storeId": "0031", "lines": held, **stamp}
    parcel = {"trackingNumber": "T-5", "carrier": "Courier", "status": "LABEL_CREATED"}
    shipment = {"eventId": "s-40", "eventType": "SHIPMENT_CREATED", **parcel, **stamp}
    stores = spark.createDataFrame([("0412", "Store", "WEST", None)], S.STORE_REFERENCE)
    out = str(tmp_path / "out")
    final = backfill(
        messages(spark, order_event(), order_event("O-2", eventTime="+12026-10-03T22:00:00Z"), "{"),
        messages(spark, inventory, "null"),
        messages(spark, shipment),
        stores,
        out,
        str(tmp_path / "dlq"),
    )
    assert final.first()["orders"] == 2
    counts = {t: spark.read.parquet(f"{out}/{t}").count() for t in list(S.TABLES)[:4] + ["dead_letter"]}
    assert counts == {
        "order_events": 1,
        "order_lines": 1,
        "inventory_events": 1,
        "shipment_events": 1,
        "dead_letter": 4,
    }
    assert spark.read.json(str(tmp_path / "dlq")).count() == 4
    row = spark.read.parquet(f"{out}/order_events").first()
    assert row["store_name"] == "Store" and row["event_date"] == datetime.date(2026, 10, 3)


def test_clean_rerun_replaces_only_its_days(spark, tmp_path):
    def rows(day, result):
        frame = spark.createDataFrame([(day, "O-1", result)], "run_date date, order_id string, classification string")
        rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in S.ORDER_RECONCILIATION.schema if f.name not in frame.columns]
        return frame.select("*", *rest)

    first, second = datetime.date(2026, 10, 3), datetime.date(2026, 10, 4)
    root = str(tmp_path)
    append_table(rows(first, "MATCH").union(rows(second, "MATCH")), S.ORDER_RECONCILIATION, root)
    for result in ("MISSING_IN_LEGACY", "AMOUNT_MISMATCH"):
        replace_day(rows(first, result), S.ORDER_RECONCILIATION, root, str(first))
    table = lambda: [
        (r["run_date"], r["classification"]) for r in spark.read.parquet(f"{root}/order_reconciliation").orderBy("run_date").collect()
    ]
    assert table() == [(first, "AMOUNT_MISMATCH"), (second, "MATCH")]
    # A re-run without rows empties the date.
    replace_day(rows(first, "MATCH").where("false"), S.ORDER_RECONCILIATION, root, str(first))
    assert table() == [(second, "MATCH")]
    with pytest.raises(Exception, match="is not of 2026-10-03"):
        replace_day(rows(second, "MATCH"), S.ORDER_RECONCILIATION, root, str(first))


def letters(spark, name, n):
    """``n`` dead letters of one writer."""
    shown = {"original_topic": F.lit(name), "stage": F.lit("PARSE"), "reason": F.lit("bad"), "failed_at": F.current_timestamp()}
    columns = [shown.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in S.DEAD_LETTER.schema]
    return spark.range(n).select(*columns)


@pytest.mark.parametrize("exactly_once", [False, True])
def test_parallel_writers_lose_nothing(spark, tmp_path, exactly_once):
    """Five queries write to one table at the same time, as those of the streaming job do."""

    def write(writer):
        for batch in range(4):
            write_batch(letters(spark, f"w{writer}", 400), S.DEAD_LETTER, str(tmp_path), f"w{writer}-{batch}", exactly_once=exactly_once)
            append_table(letters(spark, f"a{writer}", 100), S.DEAD_LETTER, str(tmp_path))

    with ThreadPoolExecutor(5) as pool:
        list(pool.map(write, range(5)))
    rows = spark.read.parquet(f"{tmp_path}/dead_letter").groupBy("original_topic").count().collect()
    assert {r["original_topic"]: r["count"] for r in rows} == {f"{k}{w}": n for w in range(5) for k, n in (("w", 1600), ("a", 400))}


def test_repeated_batches(spark, tmp_path):
    for exactly_once, total in ((True, 10), (False, 30)):
        for _ in range(2):
            write_batch(letters(spark, "x", 10), S.DEAD_LETTER, str(tmp_path), "x-0", exactly_once=exactly_once)
        assert spark.read.parquet(f"{tmp_path}/dead_letter").count() == total


def test_skipped_lines_are_counted_and_a_clean_rerun_leaves_one_run(spark, tmp_path):
    write_reconciliation_input(tmp_path)
    events_file = tmp_path / "order_events.jsonl"
    events_file.write_text(events_file.read_text() + '\n   \n{"order_id": "Z-1", "total_amount": "dear"}\n{oops\n[]\n')
    settings = dict(report=str(tmp_path / "report"), local_input=str(tmp_path), out=str(tmp_path / "out"), run_date="2025-03-08", clean=True)
    tables = ("legacy_oms_orders", "order_reconciliation", "dead_letter")
    count = lambda: [spark.read.parquet(f"{tmp_path}/out/{t}").count() for t in tables]
    done = daily_reconciliation(spark, ReconciliationSettings(**settings))
    assert (done.counts["lines_skipped"], done.counts["unreadable_events"]) == (3, 2)
    first = count()
    assert first[2] == 2
    daily_reconciliation(spark, ReconciliationSettings(**settings))
    assert count() == first
    # Nothing bad in the next run: its letters go too.
    events_file.write_text("")
    daily_reconciliation(spark, ReconciliationSettings(**settings))
    assert count() == [first[0], 5, 0]


def test_hot_day_is_split_when_written(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        frame = spark.range(40000).select(
            F.lit(datetime.datetime(2026, 10, 3)).alias("window_start"), F.sha2(F.col("id").cast("string"), 256).alias("store_id")
        )
        rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in S.STORE_ORDER_METRICS.schema if f.name not in frame.columns]
        append_table(frame.select("*", *rest), S.STORE_ORDER_METRICS, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files_ = list((tmp_path / "store_order_metrics").glob("window_date=*/batch=*/part-*.parquet"))
    assert len(files_) > 1


def test_messages_roundtrip(spark, tmp_path):
    df = messages(spark, order_event())
    for fmt in ("json", "parquet"):
        write_messages(df, str(tmp_path / fmt), fmt)
        back = read_messages(spark, str(tmp_path / fmt), fmt=fmt)
        assert back.collect() == df.collect()
    kafka = to_kafka(df.withColumn("attributes", F.create_map(F.lit("a"), F.lit("1")))).first()
    assert kafka["headers"][0]["key"] == "a" and bytes(kafka["headers"][0]["value"]) == b"1"


def test_report_is_one_file(spark, tmp_path):
    write_csv_report(spark.range(100).repartition(4), str(tmp_path / "r"))
    assert len(list((tmp_path / "r").glob("part-*.csv"))) == 1


def test_dedupe_and_latency(spark):
    t = datetime.datetime(2026, 10, 3, 22)
    later = t + datetime.timedelta(seconds=4)
    rows = spark.createDataFrame(
        [("e1", "m2", "A", t, later, later), ("e1", "m1", "A", t, later, later), ("e2", "m3", "A", t, t, later)],
        "event_id string, message_id string, event_type string, event_time timestamp, publish_time timestamp, "
        "ingested_at timestamp",
    )
    kept = events.dedupe_events(rows)
    assert sorted(r["message_id"] for r in kept.collect()) == ["m1", "m3"]
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()
    row = events.latency(rows).first()
    assert row["events"] == 3 and row["max_publish_seconds"] == 4.0 and row["avg_ingest_seconds"] == pytest.approx(4 / 3)


@pytest.mark.parametrize(
    "value, ok",
    [
        ("2026-10-03T22:14:05.120Z", True),
        ("2026-10-03T22:14Z", True),
        ("2026-10-03t22:14:05z", True),
        ("2026-10-03T22:14:05.123456789+05:30", True),
        ("2026-10-03T22:14:05-18:00", True),
        ("2026-10-03T22:14:05+18:01", False),
        ("2026-10-03T22:14:05", False),
        ("2026-10-03 22:14:05Z", False),
        ("2026-10-03", False),
        ("2024-02-29T00:00:00Z", True),
        ("2100-02-29T00:00:00Z", False),
        ("2026-04-31T00:00:00Z", False),
        ("2026-10-03T24:00:00Z", False),
        ("2026-10-03T22:14:60Z", False),
        ("2026-10-03T22:14:05.1234567890Z", False),
        ("+12026-10-03T22:14:05Z", True),
        ("", False),
        (None, False),
    ],
)
def test_rfc3339(spark, value, ok):
    df = spark.createDataFrame([(value,)], "x string")
    row = df.select(times.is_rfc3339(F.col("x")), times.to_timestamp(F.col("x"))).first()
    assert row[0] is ok
    if ok:
        assert (row[1] is not None) == (not value.startswith("+"))


def test_iso_texts(spark):
    t = F.timestamp_micros(F.lit(1_790_000_000_000_000))
    shown = [times.to_iso(t), times.to_iso(t + F.expr("interval 120 milliseconds")), times.to_iso_millis(t)]
    row = spark.range(1).select(*shown).first()
    assert tuple(row) == ("2026-09-21T14:13:20Z", "2026-09-21T14:13:20.120Z", "2026-09-21T14:13:20.000Z")


def test_files_of_a_day_do_not_grow_with_the_parts_of_a_table(spark, tmp_path):
    number, day = F.col("id"), F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(30)) * 86400)
    values = {"store_id": F.lit("0001"), "window_start": day, "window_end": day, "pane_timing": F.md5(number.cast("string"))}
    fields = S.STORE_ORDER_METRICS.schema
    rows = spark.range(0, 12000, 1, 8).select(
        *(values.get(f.name, number).cast(f.dataType).alias(f.name) for f in fields)
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    try:
        append_table(rows, S.STORE_ORDER_METRICS, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert spark.read.parquet(str(tmp_path / S.STORE_ORDER_METRICS.name)).count() == 12000
    assert len(list(tmp_path.glob("*/*/*/part-*"))) == 30
