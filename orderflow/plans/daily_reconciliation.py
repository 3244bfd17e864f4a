"""The daily job: legacy extract against landed events, two tables and a scorecard."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.operators import counters, deadletter
from orderflow.operators import reconcile as R
from orderflow.session import staged, use_utc
from orderflow.sinks import append_table, write_csv_report, write_jsonl
from orderflow.sinks.tables import replace_day
from orderflow.sources import read_order_events
from orderflow.sources.landed import events_of, judged_lines
from orderflow.sources.legacy import orders_of, read_legacy_files

log = logging.getLogger(__name__)

#: Names of refused files that are logged; all are counted.
LOGGED_FILES = 100


@dataclass(frozen=True)
class ReconciliationSettings:
    """``local_input`` (a folder with ``legacy/*.xml`` and ``order_events.jsonl``) replaces the
    tables; ``local_output`` writes JSON lines instead of tables; ``clean`` writes over the rows of the date
    that earlier runs left in the tables, and over the dead letters of earlier clean runs of that date (which are
    then filed under the date, not under the day of the run)."""

    report: str
    legacy_glob: str | None = None
    order_events: str | None = None
    out: str | None = None
    local_input: str | None = None
    local_output: str | None = None
    run_date: str | None = None
    run_id: str = "local"
    tolerance: float = 0.01
    clean: bool = False


@dataclass(frozen=True)
class ReconciliationOutputs:
    legacy: DataFrame
    results: DataFrame
    scorecard: DataFrame
    unreadable: DataFrame
    counts: dict


def daily_reconciliation(spark: SparkSession, settings: ReconciliationSettings) -> ReconciliationOutputs:
    """Reads both sides, classifies every order and writes all outputs."""
    use_utc(spark)
    s = settings
    run_date = R.resolve_run_date(s.run_date)
    glob = s.legacy_glob or (f"{s.local_input}/legacy/*.xml" if s.local_input else None)
    if glob is None:
        raise ValueError("legacy_glob is required unless local_input is set")
    # Both are used more than once: the XML is parsed, and the join run, a single time.
    counted_files, files_seen = counters.count_files(read_legacy_files(spark, glob))
    files = staged(counted_files, "legacy")
    for row in files.where("failed").select("source_file").limit(LOGGED_FILES).collect():
        log.warning("refused legacy file %s", row.source_file)
    legacy = orders_of(files)
    lines_seen = None
    if s.local_input:
        # Both the join and the dead letters read the events; the lines are read and counted once.
        lines, lines_seen = counters.count_landed(judged_lines(spark.read.text(f"{s.local_input}/order_events.jsonl")))
        events = events_of(staged(lines, "landed"))
        if lines_seen.get["lines_skipped"]:
            log.warning("skipped %d malformed lines of order events", lines_seen.get["lines_skipped"])
    else:
        events = read_order_events(spark, s.order_events, run_date)
    counted, classes = counters.count_classes(R.reconcile(legacy, events, run_date, s.tolerance))
    results = staged(counted, "reconciliation")
    # An event that can't be compared is a dead letter, not just missing.
    unreadable = staged(R.unreadable_letters(events, F.current_timestamp()), "unreadable")
    report = R.scorecard(results)
    write_csv_report(report, s.report)

    legacy_rows = R.to_legacy_rows(legacy, run_date)
    result_rows = R.to_reconciliation_rows(results, s.run_id)
    if s.local_output:
        write_jsonl(legacy_rows, s.local_output, S.LEGACY_OMS_ORDERS.name, "overwrite")
        write_jsonl(result_rows, s.local_output, S.ORDER_RECONCILIATION.name, "overwrite")
        write_jsonl(deadletter.to_dead_letter_rows(unreadable), s.local_output, S.DEAD_LETTER.name, "overwrite")
        refused = {}
    else:
        clean_day = run_date if s.clean else None
        _write_letters(unreadable, "order_events", s.out, clean_day)
        refused = {
            f"failed_inserts.{table.name}": _write_checked(rows, table, s.out, clean_day)
            for table, rows in ((S.LEGACY_OMS_ORDERS, legacy_rows), (S.ORDER_RECONCILIATION, result_rows))
        }
    seen = {**classes.get, **files_seen.get, **(lines_seen.get if lines_seen else {})}
    counts = {**seen, "unreadable_events": unreadable.count(), **refused}
    return ReconciliationOutputs(legacy, results, report, unreadable, counts)


def _write_checked(rows: DataFrame, table: S.Table, out: str, clean_day: str | None) -> int:
    """Writes accepted rows and the dead letters of refused ones; returns the number of those."""
    checked = staged(deadletter.check_rows(rows, table), table.name)
    accepted = checked.where("refusal IS NULL").select("accepted.*")
    if clean_day:
        replace_day(accepted, table, out, clean_day)
    else:
        append_table(accepted, table, out)
    _write_letters(deadletter.refused_rows(checked, table, F.current_timestamp()), table.name, out, clean_day)
    return checked.where("refusal IS NOT NULL").count()


def _write_letters(letters: DataFrame, source: str, out: str, clean_day: str | None) -> None:
    rows = deadletter.to_dead_letter_rows(letters)
    if clean_day:
        replace_day(rows, S.DEAD_LETTER, out, clean_day, f"daily-{source}")
    else:
        append_table(rows, S.DEAD_LETTER, out)
