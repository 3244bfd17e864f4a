"""Command line: ``python -m orderflow {order-events,daily-reconciliation,store-revenue} ...``."""

from __future__ import annotations

import argparse

from orderflow.plans.daily_reconciliation import ReconciliationSettings, daily_reconciliation
from orderflow.plans.store_revenue import store_revenue
from orderflow.session import get_spark
from orderflow.sources import read_messages, read_store_reference
from orderflow.streaming.jobs import StreamSettings, start_streams


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="orderflow", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    events = jobs.add_parser("order-events", help="streams to event tables, metrics and dead letters")
    for kind in ("orders", "inventory", "shipments"):
        events.add_argument(f"--{kind}", required=True, help="folder of messages, or topic for kafka")
    events.add_argument("--format", default="json", choices=["json", "parquet", "kafka"])
    events.add_argument("--source-option", action="append", default=[], metavar="KEY=VALUE")
    events.add_argument("--store-reference", help="CSV store_id,store_name,region,timezone")
    events.add_argument("--out", required=True, help="folder of the tables")
    events.add_argument("--checkpoints", required=True, help="shared folder of query progress")
    events.add_argument("--dead-letters", help="folder of dead-letter messages, or topic for kafka")
    events.add_argument("--dead-letter-format", default="json", choices=["json", "parquet", "kafka"])
    events.add_argument("--dead-letter-option", action="append", default=[], metavar="KEY=VALUE")
    events.add_argument("--jsonl", action="store_true", help="JSON lines instead of tables")
    events.add_argument("--window-minutes", type=int, default=1)
    events.add_argument("--lateness-minutes", type=int, default=5)
    events.add_argument("--early-seconds", type=int, default=30)
    events.add_argument("--dedupe-minutes", type=int, default=0, help="leave out messages repeated within this time")
    events.add_argument("--flush-seconds", type=int, default=10)
    events.add_argument("--at-least-once", action="store_true", help="plain appends, possible duplicates")
    events.add_argument("--available-now", action="store_true", help="process what is there and stop")

    daily = jobs.add_parser("daily-reconciliation", help="legacy extract against landed events")
    daily.add_argument("--legacy", help="glob of XML files")
    daily.add_argument("--order-events", help="the order_events table")
    daily.add_argument("--run-date", help="yyyy-MM-dd, yesterday (UTC) if blank")
    daily.add_argument("--run-id", default="local")
    daily.add_argument("--report", required=True, help="folder of the CSV scorecard")
    daily.add_argument("--out", help="folder of the tables")
    daily.add_argument("--local-input", help="folder with legacy/*.xml and order_events.jsonl")
    daily.add_argument("--local-output", help="JSON lines instead of tables")
    daily.add_argument("--tolerance", type=float, default=0.01)
    daily.add_argument("--clean", action="store_true", help="write over the date's rows of earlier runs")

    revenue = jobs.add_parser("store-revenue", help="revenue per store from a CSV of orders")
    revenue.add_argument("--input", required=True)
    revenue.add_argument("--output", required=True)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _arguments().parse_args(argv)
    spark = get_spark(f"orderflow-{args.job}")
    if args.job == "store-revenue":
        store_revenue(spark, args.input, args.output)
    elif args.job == "daily-reconciliation":
        if not args.local_input and not args.order_events:
            raise SystemExit("--order-events is required unless --local-input is set")
        if not args.local_output and not args.out:
            raise SystemExit("--out is required unless --local-output is set")
        daily_reconciliation(
            spark,
            ReconciliationSettings(
                report=args.report,
                legacy_glob=args.legacy,
                order_events=args.order_events,
                out=args.out,
                local_input=args.local_input,
                local_output=args.local_output,
                run_date=args.run_date,
                run_id=args.run_id,
                tolerance=args.tolerance,
                clean=args.clean,
            ),
        )
    else:
        _order_events(spark, args)


def _order_events(spark, args) -> None:
    settings = StreamSettings(
        out=args.out,
        checkpoints=args.checkpoints,
        dead_letters=args.dead_letters,
        dead_letter_format=args.dead_letter_format,
        dead_letter_options=dict(option.split("=", 1) for option in args.dead_letter_option),
        jsonl=args.jsonl,
        exactly_once=not args.at_least_once,
        flush_seconds=args.flush_seconds,
        window_minutes=args.window_minutes,
        lateness_minutes=args.lateness_minutes,
        early_seconds=args.early_seconds,
        dedupe_minutes=args.dedupe_minutes,
    )
    options = dict(option.split("=", 1) for option in args.source_option)
    streams = [
        read_messages(spark, source, fmt=args.format, stream=True, **options)
        for source in (args.orders, args.inventory, args.shipments)
    ]
    stores = read_store_reference(spark, args.store_reference)
    queries = start_streams(*streams, stores, settings, args.available_now)
    for query in queries:
        query.awaitTermination()


if __name__ == "__main__":
    main()
