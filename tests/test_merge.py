import pytest
from pyspark.sql import functions as F

from conftest import rows
from strata.operators.merge import (Matched, MergeError, NotMatched, merge, merge_guarded,
                                    merge_insert_only, merge_upsert)

T = "id int, v string, n int"


def test_condition_true_false_null_and_unmatched(spark):
    target = spark.createDataFrame([(1, "t1", 1), (2, "t2", 5), (3, "t3", None), (9, "t9", 0)], T)
    source = spark.createDataFrame([(1, "s1", 2), (2, "s2", 3), (3, "s3", 4), (4, "s4", 0)], T)
    out = merge(target, source, "id", [Matched(cond=lambda t, s: s["n"] >= t["n"])], [NotMatched()])
    # 1: true → update; 2: false → keep; 3: NULL → keep (never falls through to insert);
    # 4: unmatched → insert; 9: target only → kept
    assert rows(out) == [(1, "s1", 2), (2, "t2", 5), (3, "t3", None), (4, "s4", 0), (9, "t9", 0)]


def test_two_source_rows_for_one_target_row_is_an_error(spark):
    target = spark.createDataFrame([(1, "t", 0)], T)
    source = spark.createDataFrame([(1, "a", 0), (1, "b", 0)], T)
    with pytest.raises(Exception, match="several source rows"):
        merge_upsert(target, source, "id").collect()
    with pytest.raises(Exception, match="several source rows"):
        merge_upsert(target, source, "id").count()          # no output column is read


def test_null_keys_never_match(spark):
    target = spark.createDataFrame([(None, "t", 0)], T)
    source = spark.createDataFrame([(None, "s", 0)], T)
    assert rows(merge_upsert(target, source, "id")) == [(None, "s", 0), (None, "t", 0)]


def test_guarded_upsert_keeps_rows_owned_by_another_source(spark):
    S = "id int, v string, source string"
    target = spark.createDataFrame([(1, "stream-row", "stream"), (2, "old", "batch")], S)
    incoming = spark.createDataFrame([(1, "batch-row", "batch"), (2, "new", "batch"), (3, "ins", "batch")], S)
    out = merge_guarded(target, incoming, "id", "source", "batch")
    assert rows(out) == [(1, "stream-row", "stream"), (2, "new", "batch"), (3, "ins", "batch")]


def test_insert_only_never_updates(spark):
    target = spark.createDataFrame([(1, "keep", 0)], T)
    source = spark.createDataFrame([(1, "ignored", 1), (2, "new", 2)], T)
    assert rows(merge_insert_only(target, source, "id")) == [(1, "keep", 0), (2, "new", 2)]


def test_partial_update_delete_and_extra_target_condition(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], T)
    source = spark.createDataFrame([(1, "x", 10), (2, "y", 20), (3, "z", 30)], T)
    out = merge(target, source, "id",
                [Matched(cond=lambda t, s: t["n"] == 2, delete=True),
                 Matched(update={"n": lambda t, s: s["n"] + 1})],
                target_condition=lambda t: t["v"] != F.lit("c"))
    assert rows(out) == [(1, "a", 11), (3, "c", 3)]


def test_star_needs_every_target_column_in_source(spark):
    target = spark.createDataFrame([(1, "a", 1)], T)
    source = spark.createDataFrame([(1, "x")], "id int, v string")
    with pytest.raises(MergeError):
        merge_upsert(target, source, "id")


def test_single_merge_silver_orders_equals_two_step(spark):
    from datetime import datetime

    from strata.operators.late import stream_orders
    from strata.plans import medallion as M
    t0 = datetime(2024, 1, 1)
    O = M.ORDERS_SCHEMA
    target = spark.createDataFrame([
        ("k1", 1, 1, 1, 1.0, 1.0, "paid", t0, "batch", t0),
        ("k2", 1, 1, 1, 1.0, 1.0, "paid", t0, "stream", t0),     # stream-owned: batch must not overwrite
        ("k3", 1, 1, 1, 1.0, 1.0, "paid", t0, "batch", t0),
        ("k6", 1, 1, 1, 1.0, 1.0, "paid", t0, "stream", t0),     # stream-owned, stream updates it
    ], O)
    batch = spark.createDataFrame([
        ("k1", 2, 2, 2, 2.0, 4.0, "shipped", t0, "batch", t0),
        ("k2", 2, 2, 2, 2.0, 4.0, "shipped", t0, "batch", t0),
        ("k4", 2, 2, 2, 2.0, 4.0, "shipped", t0, "batch", t0),
        ("k5", 2, 2, 2, 2.0, 4.0, "shipped", t0, "batch", t0),   # also in the stream: stream wins
    ], O)
    E = ("event_id string, order_id string, customer_id bigint, product_id bigint, quantity int, "
         "unit_price double, status string, event_time timestamp_ntz, _ingested_at timestamp_ntz")
    accepted = spark.createDataFrame([
        ("e1", "k5", 3, 3, 3, 1.5, "completed", t0, t0),
        ("e2", "k6", 3, 3, 3, 1.5, "cancelled", t0, t0),
        ("e3", "k7", 3, 3, 3, 1.5, "created", t0, t0),
    ], E)
    one = M.silver_orders(spark, batch, accepted, previous=target)
    two = merge_upsert(merge_guarded(target, batch, "order_id", "source", "batch"),
                       stream_orders(accepted).select(*M.ORDER_COLUMNS), "order_id")
    assert one.count() == 7
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0
    assert rows(one.filter("order_id = 'k2'"), "status", "source") == [("paid", "stream")]


def test_insert_only_has_no_full_outer_join_and_keeps_clause_rules(spark):
    from strata.operators.merge import NotMatched, merge
    t = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    s = spark.createDataFrame([(1, "x"), (2, "y"), (None, "m"), (3, "skip")], "k int, v string")
    out = merge(t, s, "k", [], [NotMatched(cond=lambda t, s: s["v"] != "skip")])
    assert "FullOuter" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(1, "a"), (None, "n"), (2, "y"), (None, "m")], key=repr)


def test_batch_orders_stay_where_their_join_left_them(spark, tmp_dir):
    """Dedup by order_id and the meeting with the stream shuffle no order line a second time."""
    from datetime import datetime
    from strata.plans import medallion as M
    from strata.sources.driver_tables import ORDER_KEY, DriverTables
    day = lambda n: datetime(1997, 1, 1 + n % 28)
    lines = [(k, k % 11, k % 40, None if k == 5 else n, 5.0, 10.0 * n, "R", "O", day(k + n)) for k in range(-3, 60) for n in (1, 1, 2)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                                 "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{tmp_dir}/lineitem.parquet")
    orders = [(k, k % 7, day(k)) for k in range(-3, 60)] + [(8, 99, day(1))]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{tmp_dir}/orders.parquet")
    events = [(str(i), o, 1, 2, 3, 4.0, "paid", day(i), day(i)) for i, o in enumerate(["1-1", "-2-1", "U-1", "x-1", "2-", "3-1-1", "99999999999999999999-1", "1-1"])]
    accepted = spark.createDataFrame(events, "event_id string, order_id string, customer_id long, product_id long, quantity int, unit_price double, "
                                             "status string, event_time timestamp_ntz, _ingested_at timestamp_ntz")
    dt = DriverTables(spark, tmp_dir)
    kept, shuffled = M.batch_orders(dt.order_lines()), M.batch_orders(dt.orders_raw())
    assert rows(kept.drop(ORDER_KEY)) == rows(shuffled)
    silver = M.silver_orders(spark, kept, accepted)
    assert rows(silver) == rows(M.silver_orders(spark, shuffled, accepted))
    assert {r.order_id: r.source for r in silver.filter("order_id IN ('1-1', '-2-1', '1-2')").collect()} == {"1-1": "stream", "-2-1": "stream", "1-2": "batch"}
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2     # the two sides of the join, nothing behind it
    # a check that groups by the number as well counts alike, NULL ids being one group
    from strata.operators import quality as dq
    checks = [dq.duplicates("d", "t", "order_id", within=ORDER_KEY)]
    assert [dq.run_checks({"t": t}, checks, "s").first().violations for t in (dt.order_lines(), dt.orders_raw())] == [
        dt.orders_raw().count() - dt.orders_raw().select("order_id").distinct().count()] * 2
