"""Every registered query against its SQL, on the smallest given tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from orderflow.plans import queries, wire
from orderflow.plans.oracles import ORACLES
from orderflow.plans.queries import QUERIES
from tests.oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, tables, name):
    assert compare(spark, tables, name, SF_DIR) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_messages_are_made_and_parsed_once_to_be_counted_by_outcome(spark, capsys):
    entry.queries()["split_valid"](spark, SF_DIR).explain()
    assert capsys.readouterr().out.count("/orders.parquet") == 1


def test_tasks_of_messages_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(wire, "TASK_ROWS", 500)
    lines = wire.table(spark, SF_DIR, "lineitem")
    dealt = wire.spread(lines, "l_orderkey")
    assert dealt.rdd.getNumPartitions() == -(-lines.count() // 500)
    assert dealt.count() == lines.count()


def test_queries_ask_for_methods_that_are_compiled(spark):
    entry.queries()["store_reference"](spark, SF_DIR)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_json_lines_of_a_large_table_are_written_compressed(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "shared_dir", lambda _: str(tmp_path))
    assert compare(spark, tables, "table_jsonl", SF_DIR) == ""
    files = list(tmp_path.glob("jsonl/*/*/part-*"))
    assert files and all(file.suffix == ".gz" for file in files)


@pytest.mark.parametrize("name", ["metric_panes", "latest_panes"])
def test_windows_of_events_just_before_their_ends(spark, tmp_path, name):
    """Less than half a millisecond before an hour, or half an hour, as events of a large table are."""
    duckdb.execute(
        f"""COPY (SELECT i AS event_id, TIMESTAMP '2024-01-20 00:00:00' + TO_MICROSECONDS(CAST((i + 1) * 1800000000 - gap AS BIGINT)) AS ts,
          CAST(7 AS BIGINT) AS user_id, 'purchase' AS event_type, i + 0.5::DOUBLE AS value, '{{}}' AS props
        FROM range(6) t(i), (VALUES (0), (1), (400), (500), (501), (999), (1000)) g(gap)) TO '{tmp_path}/events.parquet'"""
    )
    assert compare(spark, connect(tmp_path), name, str(tmp_path)) == ""


def test_rows_of_other_types_and_days_are_dropped_before_they_are_flattened(spark, monkeypatch):
    flattened, flatten = [], queries.enrich.to_order_events
    monkeypatch.setattr(queries.enrich, "to_order_events", lambda rows: flattened.append(rows) or flatten(rows))
    entry.queries()["landed_day"](spark, SF_DIR)
    rows = flattened[0].select("event.eventType", "event.eventTime").collect()
    assert all(r["eventType"] == "ORDER_CREATED" and r["eventTime"].startswith(queries.RUN_DATE) for r in rows)


def test_rows_of_messages_pass_no_generator(spark):
    """A generator evaluates its columns without generated code and copies each row twice."""
    plan = entry.queries()["shipment_events"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 3 and "Generate " not in plan


def test_lists_of_lines_hold_what_is_needed_and_are_put_together_before(spark):
    landed = queries.landed(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "l_suppkey" not in landed and "Generate inline" not in landed
    for lines in (wire.orders_with_lines(spark, SF_DIR), wire.landed_lines(spark, SF_DIR)):
        plan = lines._jdf.queryExecution().executedPlan().toString()
        assert "collect_list(line#" in plan and "collect_list(struct" not in plan
