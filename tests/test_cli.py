import json

import pytest

from orderflow.__main__ import main
from tests.samples import message, order_event, write_reconciliation_input
from tests.test_streaming import put


def test_revenue(spark, tmp_path):
    (tmp_path / "in.csv").write_text("order_id,store_id,amount\nA,1,2.50\n")
    main(["store-revenue", "--input", str(tmp_path / "in.csv"), "--output", str(tmp_path / "out")])
    assert next((tmp_path / "out").glob("part-*.csv")).read_text() == "store_id,revenue\n1,2.50\n"


def test_reconciliation(spark, tmp_path):
    write_reconciliation_input(tmp_path)
    base = ["daily-reconciliation", "--run-date", "2025-03-08", "--report", str(tmp_path / "report")]
    main([*base, "--local-input", str(tmp_path), "--local-output", str(tmp_path / "out")])
    report = next((tmp_path / "report").glob("part-*.csv")).read_text().splitlines()
    assert report[0] == "run_date,classification,count" and "2025-03-08,MATCH,2" in report
    with pytest.raises(SystemExit):
        main(base)
    with pytest.raises(ValueError):
        main([*base[:2], "10/03/2026", *base[3:], "--local-input", str(tmp_path), "--local-output", "x"])


def test_order_events(spark, tmp_path):
    put(tmp_path / "orders", 0, message(order_event("1"), 1, 10), message("{", 2, 11))
    (tmp_path / "inventory").mkdir()
    (tmp_path / "shipments").mkdir()
    args = ["order-events", "--jsonl", "--available-now"]
    for kind in ("orders", "inventory", "shipments", "out", "checkpoints"):
        args += [f"--{kind}", str(tmp_path / kind)]
    main(args)
    files = (tmp_path / "out").glob("store_order_metrics/batch=*/part-*")
    panes = [json.loads(x) for f in files for x in f.read_text().splitlines()]
    assert [(p["pane_timing"], p["orders"], p["is_last"]) for p in panes] == [("EARLY", 1, False)]
    assert len(list((tmp_path / "out").glob("dead_letter/batch=*/part-*"))) >= 1
