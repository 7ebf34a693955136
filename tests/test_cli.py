from strata.__main__ import main
from strata.session import scratch_path


def test_run_then_show(spark, capsys):
    root = scratch_path(spark, "cli")
    assert main(["run", "--sf-dir", "/root/testdata/sf0.001", "--root", root, "--snapshot", "day1"]) == 0
    out = capsys.readouterr().out
    assert "gold.fact_orders" in out and "warnings: orders_raw_duplicate_ids" in out
    assert main(["show", "--root", root, "--layer", "silver"]) == 0
    shown = capsys.readouterr().out
    assert "order_events" in shown and "customers" in shown
