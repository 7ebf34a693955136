import pytest

from strata.operators.quality import QualityGateError
from strata.plans import medallion as M
from strata.plans.runner import run_medallion
from strata.session import scratch_path

SF = "/root/testdata/sf0.001"


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_two_snapshots_then_rerun_is_idempotent(spark):
    root = scratch_path(spark, "test-medallion")
    run_medallion(spark, SF, root, "day1")
    r2 = run_medallion(spark, SF, root, "day2")
    r3 = run_medallion(spark, SF, root, "day2")
    layers = M.build_layers(spark, SF)
    for name in ["silver.customers", "silver.orders", "gold.dim_customer", "gold.fact_orders", "gold.daily_sales"]:
        assert _same(r2.tables[name], layers[name]), name
        assert _same(r3.tables[name], r2.tables[name]), name
    assert sorted(r2.warnings) == ["orders_raw_duplicate_ids", "orders_raw_negative_values", "orders_raw_null_keys"]
    assert r3.rows_written["gold.dim_customer"] == r3.tables["gold.dim_customer"].count()
    assert r3.rows_written["silver.orders"] == layers["silver.orders"].count()
    assert r3.tables["audit.dq_results"].count() == 3 * 21
    assert r3.tables["audit.ge_results"].count() == 3 * 15


def test_unknown_snapshot_is_rejected(spark):
    with pytest.raises(ValueError):
        run_medallion(spark, SF, scratch_path(spark, "x"), "day3")


def test_gate_blocks_on_error(spark, monkeypatch):
    from strata.operators import quality as dq
    original = M.checks

    def failing():
        c = original()
        c["bronze"].append(dq.predicate("always_fails", "bronze.orders_raw", "TRUE", dq.ERROR))
        return c
    monkeypatch.setattr(M, "checks", failing)
    with pytest.raises(QualityGateError, match="always_fails"):
        run_medallion(spark, SF, scratch_path(spark, "gate"), "day1")


def test_replaying_day1_after_day2_changes_nothing(spark):
    root = scratch_path(spark, "test-replay")
    run_medallion(spark, SF, root, "day1")
    r2 = run_medallion(spark, SF, root, "day2")
    r3 = run_medallion(spark, SF, root, "day1")
    for name in ["silver.customers", "gold.dim_customer", "gold.fact_orders"]:
        assert _same(r3.tables[name], r2.tables[name]), name


@pytest.mark.parametrize("name", ["daily_sales", "surrogate_keys", "merge_conditional", "asof_lookup"])
def test_results_do_not_depend_on_shuffle_width(spark, name):
    from strata.plans.catalog import queries
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = queries()[name](spark, SF).collect()
        spark.conf.set("spark.sql.shuffle.partitions", "17")
        b = queries()[name](spark, SF).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sorted(map(tuple, a), key=repr) == sorted(map(tuple, b), key=repr)


def test_unroutable_events_are_kept_on_request(spark):
    r = run_medallion(spark, SF, scratch_path(spark, "unroutable"), "day1", keep_unroutable=True)
    # the driver data has no NULL order ids, so the table exists and is empty
    assert r.tables["silver.order_events_unroutable"].count() == 0


def _own_files(spark, status="paid", events=True):
    """CSV folders (one row group of each table, columns in another order) and a bronze table as the stream leaves it."""
    from strata.streaming.ingest import file_records, start_ingest
    root = scratch_path(spark, "own")
    write = lambda rows, cols, name: spark.createDataFrame(rows, cols).write.option("header", True).csv(f"{root}/in/{name}")
    write([("Ann", "1", "a@x", "Rome", "S", "2020-01-01", "2024-01-01 00:00:00")], "full_name string, customer_id string, email string, "
          "city string, segment string, signup_date string, updated_at string", "customers")
    write([("2.5", "7", "toys", "ball")], "unit_price string, product_id string, category string, product_name string", "products")
    write([("b1", "1", "7", "2", "2.5", "5.0", "completed", "2024-01-05 00:00:00")], "order_id string, customer_id string, product_id string, "
          "quantity string, unit_price string, total_amount string, status string, order_ts string", "orders")
    if not events:
        return root
    event = ('{"event_id": "e1", "order_id": "s1", "customer_id": 1, "product_id": 7, "quantity": 1, "unit_price": 2.5, "status": "%s", '
             '"event_time": "2024-01-06T00:00:00Z", "produced_at": "2024-01-06 00:00:00"}' % status)
    spark.createDataFrame([(event, 0, 0)], "value string, partition int, offset bigint").write.parquet(f"{root}/landing")
    from pyspark.sql import functions as F
    start_ingest(file_records(spark, f"{root}/landing"), f"{root}/lake/bronze/order_events", f"{root}/ckpt", {"availableNow": True},
                 F.col("event_time")).awaitTermination()
    return root


def test_csv_files_and_streamed_events_reach_gold(spark):
    from strata.__main__ import main
    root = _own_files(spark)
    own = [x for n in ("customers", "products", "orders") for x in (f"--{n}", f"{root}/in/{n}")]
    assert main(["run", *own, "--root", f"{root}/lake"]) == 0
    from strata.sinks.store import read_latest
    orders = read_latest(spark, f"{root}/lake/silver/orders").collect()
    assert sorted((r.order_id, r.source) for r in orders) == [("b1", "batch"), ("s1", "stream")]
    assert read_latest(spark, f"{root}/lake/gold/fact_orders").count() == 2
    assert main(["run", "--customers", "x", "--root", root]) == 1


def test_a_failed_expectation_fails_the_run_after_its_audit_row(spark):
    from strata.operators.expectations import ExpectationsFailed
    from strata.plans.runner import Inputs, run_pipeline
    root = _own_files(spark, status="lost")
    with pytest.raises(ExpectationsFailed):
        run_pipeline(spark, Inputs(*(f"{root}/in/{n}" for n in ("customers", "products", "orders"))), f"{root}/lake")
    assert spark.read.parquet(f"{root}/lake/audit/ge_results").filter("NOT success").count() == 1


OWN = ("customers", "products", "orders")


def _inputs(root):
    from strata.plans.runner import Inputs
    return Inputs(*(f"{root}/in/{n}" for n in OWN))


def test_a_run_without_any_event(spark):
    from strata.plans.runner import run_pipeline
    root = _own_files(spark, events=False)
    for _ in range(2):
        r = run_pipeline(spark, _inputs(root), f"{root}/lake")
    assert r.tables["silver.order_events"].count() == r.tables["silver.order_events_rejected"].count() == 0
    assert [x.order_id for x in r.tables["gold.fact_orders"].collect()] == ["b1"]
    # an event table without rows, as a DataFrame and as a folder that a broken-off first write left
    none = r.tables["bronze.order_events"].drop("dt")
    import dataclasses
    r = run_pipeline(spark, dataclasses.replace(_inputs(root), events=none), f"{root}/lake2")
    assert r.tables["gold.fact_orders"].count() == 1
    spark.range(1).write.parquet(f"{root}/lake3/bronze/order_events/_temporary/0/task_0")
    assert run_pipeline(spark, _inputs(root), f"{root}/lake3").tables["gold.fact_orders"].count() == 1


def test_runs_with_a_dataframe_leave_the_streams_table_alone(spark):
    import dataclasses
    from strata.plans.runner import run_pipeline
    root = _own_files(spark)
    lake = f"{root}/lake"
    streamed = spark.read.parquet(f"{lake}/bronze/order_events").drop("dt")
    copy = spark.createDataFrame(streamed.collect(), streamed.schema)
    for _ in range(2):
        run_pipeline(spark, dataclasses.replace(_inputs(root), events=copy), lake)
    r = run_pipeline(spark, _inputs(root), lake)
    assert r.tables["bronze.order_events"].count() == 1
    assert r.tables["gold.fact_orders"].count() == 2


@pytest.mark.parametrize("table", ["checks.bronze", "silver.orders", "gold.dim_customer"])
def test_a_killed_run_goes_on_where_it_stopped(spark, monkeypatch, table):
    """Killed after the table is written and before the ledger has it; and after the ledger has it."""
    from strata.plans.runner import run_pipeline
    from strata.sinks import store
    from strata.sinks.ledger import Ledger
    root = _own_files(spark)
    finish = Ledger.finish
    for lake, after in ((f"{root}/lake", False), (f"{root}/lake", True)):
        def dies(self, name, *a, **k):
            if after:
                finish(self, name, *a, **k)
            if name == table:
                raise KeyboardInterrupt(name)
            if not after:
                finish(self, name, *a, **k)
        monkeypatch.setattr(Ledger, "finish", dies)
        with pytest.raises(KeyboardInterrupt):
            run_pipeline(spark, _inputs(root), lake, run_id=f"r{after}")
        monkeypatch.setattr(Ledger, "finish", finish)
        written = []
        monkeypatch.setattr(store, "write_version", lambda df, base, *a, f=store.write_version, **k: (written.append(base), f(df, base, *a, **k))[1])
        r = run_pipeline(spark, _inputs(root), lake, run_id=f"r{after}")
        monkeypatch.undo()
        done = ["bronze.customers_raw", "bronze.products_raw", "bronze.orders_raw"]
        assert not [w for w in written for d in done if w.endswith(d.replace(".", "/"))]
        assert sorted(tuple(x) for x in r.tables["gold.daily_sales"].collect()) == [(20240105, "toys", 1, 2, 5.0)]
        assert r.tables["silver.order_events"].count() == 1 and r.tables["gold.dim_customer"].count() == 1
        assert r.tables["audit.dq_results"].filter(f"run_ts = timestamp_ntz'{r.as_of}'").count() == 21
        assert r.tables["audit.ge_results"].filter(f"run_ts = timestamp_ntz'{r.as_of}'").count() == 15


def test_stage_commands(spark, capsys):
    from strata.__main__ import main
    root = _own_files(spark)
    lake = f"{root}/lake"
    own = [x for n in OWN for x in (f"--{n}", f"{root}/in/{n}")]
    assert main(["seed", *own, "--root", lake]) == 0
    assert main(["dq", "bronze", "--root", lake]) == 0
    assert main(["run", *own, "--root", lake, "--run-id", "a.1"]) == 0
    assert main(["dq", "silver", "--root", lake]) == main(["dq", "gold", "--root", lake]) == main(["expect", "--root", lake]) == 0
    assert spark.read.parquet(f"{lake}/audit/dq_results").count() == 7 + 21 + 8 + 6
    assert main(["show", "--root", lake]) == 0


def test_expire_keeps_the_newest_versions_and_young_ones(spark):
    import os
    from strata.sinks import store
    base = scratch_path(spark, "expire")
    for i in range(4):
        store.write_version(spark.range(i), base)
    spark.range(1).write.parquet(f"{base}/v=9/_temporary/x")
    assert store.expire(spark, base, 2, 3600) == []
    reading = spark.read.parquet(f"{base}/v=2")
    assert [os.path.basename(p) for p in store.expire(spark, base, 2, -1)] == ["v=0", "v=1", "v=9"]
    assert reading.count() == 2 and store.read_latest(spark, base).count() == 3
    with pytest.raises(ValueError):
        store.expire(spark, base, 0, 0)


def test_a_fact_outside_the_calendar_fails_its_check(spark):
    from datetime import date
    from strata.plans.runner import run_pipeline
    root = _own_files(spark)
    days = lambda last: (date(2024, 1, 1), date(2024, 1, last))
    with pytest.raises(QualityGateError, match="fact_orders_valid_date_key"):
        run_pipeline(spark, _inputs(root), f"{root}/lake", calendar=days(5))
    r = run_pipeline(spark, _inputs(root), f"{root}/lake", calendar=days(6))
    assert r.tables["gold.dim_date"].count() == 6 and r.tables["gold.fact_orders"].count() == 2
