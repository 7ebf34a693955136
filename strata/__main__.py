"""Command line: ``python -m strata <command>`` (submit with spark-submit on a cluster).

  seed    load the bronze tables alone
  dq      the checks of one stage (bronze, silver or gold) over the stored tables
  expect  the expectation suites over the stored tables
  run     one medallion run for a snapshot: bronze → gate → silver → gate →
          gold → gate → expectations, tables under --root; with --run-id a run
          that broke off goes on where it stopped
  stream  start the event ingestion stream (file folder or Kafka) into bronze
  show    row counts (and optionally a preview) of the stored layer tables
"""

from __future__ import annotations

import argparse
import sys
from datetime import date

from strata.session import get_spark


def _gated(a, name: str, work) -> int:
    """Run ``work(spark)``; a failed gate or expectation is exit code 2."""
    from strata.operators.expectations import ExpectationsFailed
    from strata.operators.quality import QualityGateError
    spark = get_spark(f"strata-{name}", master=a.master, cluster=a.cluster)
    try:
        r = work(spark)
    except (QualityGateError, ExpectationsFailed) as e:
        print(e, file=sys.stderr)
        return 2
    for table, n in r.rows_written.items():
        print(f"{table:32s} {n:>12d} rows")
    if r.warnings:
        print("warnings:", ", ".join(r.warnings))
    return 0


def _dq(a) -> int:
    from strata.plans.runner import check_stage
    return _gated(a, "dq", lambda spark: check_stage(spark, a.root, a.stage, a.as_of))


def _expect(a) -> int:
    from strata.plans.runner import check_expectations
    return _gated(a, "expect", lambda spark: check_expectations(spark, a.root, a.as_of))


def _run(a) -> int:
    from strata.plans.runner import Inputs, driver_inputs, run_pipeline, seed
    own = [a.customers, a.products, a.orders]
    if bool(a.sf_dir) == any(own) or any(own) and not all(own):
        print("give either --sf-dir or all of --customers, --products and --orders", file=sys.stderr)
        return 1

    def work(spark):
        inputs = driver_inputs(spark, a.sf_dir, a.snapshot) if a.sf_dir else Inputs(*own, a.events)
        if a.cmd == "seed":
            return seed(spark, inputs, a.root, a.snapshot, a.as_of)
        days = tuple(map(date.fromisoformat, a.calendar)) if a.calendar else None
        return run_pipeline(spark, inputs, a.root, a.snapshot, a.as_of, run_id=a.run_id, calendar=days)
    return _gated(a, a.cmd, work)


def _stream(a) -> int:
    from strata.streaming.ingest import file_records, kafka_records, start_ingest
    spark = get_spark("strata-stream", master=a.master, cluster=a.cluster)
    records = kafka_records(spark, a.kafka, a.topic) if a.kafka else file_records(spark, a.landing)
    trigger = {"availableNow": True} if a.once else {"processingTime": a.trigger}
    q = start_ingest(records, a.out, a.checkpoint, trigger, dedup_within=a.dedup_within)
    q.awaitTermination()
    return 0


def _show(a) -> int:
    from strata.operators.profile import layer_profile, preview
    from strata.plans.medallion import Layers
    from strata.sinks.store import has_data, read_latest
    spark = get_spark("strata-show", master=a.master, cluster=a.cluster)
    tables = {}
    for layer, names in {**Layers.NAMES, "audit": ["dq_results", "ge_results"]}.items():
        names = [*names, "order_events_loaded"] if layer == "bronze" else names
        if a.layer not in ("all", layer):
            continue
        for t in names:
            path = f"{a.root.rstrip('/')}/{layer}/{t}"
            try:
                tables[f"{layer}.{t}"] = read_latest(spark, path)
            except FileNotFoundError:
                if has_data(spark, path):  # in-place table (appended history)
                    tables[f"{layer}.{t}"] = spark.read.parquet(path)
                else:
                    print(f"{layer}.{t}: not available")
    if tables:
        layer_profile(tables).show(len(tables), truncate=False)
        if a.preview:
            for name, df in tables.items():
                print(name)
                preview(df).show(truncate=False)
    return 0


def _input_arguments(r) -> None:
    r.add_argument("--sf-dir", help="folder of the driver's tables; or name files of your own:")
    r.add_argument("--customers", help="CSV path, header required (so for products and orders)")
    r.add_argument("--products")
    r.add_argument("--orders")
    r.add_argument("--events", help="table of decoded events (default: the stream's, <root>/bronze/order_events)")
    r.add_argument("--root", required=True, help="table folder in shared storage")
    r.add_argument("--snapshot", default="day1", help="label of the customer dump (day1 or day2 with --sf-dir)")
    r.add_argument("--as-of", help="run clock as a UTC timestamp (default: now)")


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="strata")
    p.add_argument("--master", default=None, help="e.g. local[*]; left to spark-submit when omitted")
    p.add_argument("--cluster", action="store_true", help="apply the large-cluster sizing (CLUSTER_CONF)")
    sub = p.add_subparsers(dest="cmd", required=True)
    runs = [sub.add_parser(name) for name in ("run", "seed")]
    runs[0].add_argument("--run-id", help="keep a ledger under this name; start again with it after a crash")
    runs[0].add_argument("--calendar", nargs=2, metavar=("FIRST", "LAST"), help="days of the date dimension (default: those of the orders)")
    for r in runs:
        _input_arguments(r)
    for name in ("dq", "expect"):
        c = sub.add_parser(name)
        if name == "dq":
            c.add_argument("stage", choices=["bronze", "silver", "gold"])
        c.add_argument("--root", required=True)
        c.add_argument("--as-of", help="clock of the audit rows as a UTC timestamp (default: now)")
    s = sub.add_parser("stream")
    s.add_argument("--landing", help="folder of (value, partition, offset) parquet records")
    s.add_argument("--kafka", help="bootstrap servers; reads --topic instead of --landing")
    s.add_argument("--topic", default="orders_events")
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--trigger", default="30 seconds")
    s.add_argument("--dedup-within", help="drop an event delivered again within this time of arrival, e.g. '1 hour'")
    s.add_argument("--once", action="store_true", help="process what is available, then stop")
    sh = sub.add_parser("show")
    sh.add_argument("--root", required=True)
    sh.add_argument("--layer", default="all", choices=["all", "bronze", "silver", "gold", "audit"])
    sh.add_argument("--preview", action="store_true")
    a = p.parse_args(argv)
    return {"run": _run, "seed": _run, "dq": _dq, "expect": _expect, "stream": _stream, "show": _show}[a.cmd](a)


if __name__ == "__main__":
    sys.exit(main())
