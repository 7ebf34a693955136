import os

import pytest

from conftest import rows, ts
from strata.session import scratch_path
from strata.streaming.ingest import bronze_events, file_records, route_each_batch, silver_events_sink, start_ingest


def _land(spark, folder, recs):
    spark.createDataFrame(recs, "value string, partition int, offset bigint").write.mode("append").parquet(folder)


def _ev(i, t="2024-01-01 00:00:00"):
    return (f'{{"event_id": "e{i}", "order_id": "o{i % 2}", "quantity": 1, "event_time": "{t}", '
            f'"produced_at": "{t}"}}', i % 3, i)


def test_available_now_ingest_restarts_without_duplicates(spark, tmp_dir):
    landing, out, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "bronze", "ckpt"))
    _land(spark, landing, [_ev(1), _ev(2), ("not json", 0, 3)])
    start_ingest(file_records(spark, landing), out, ckpt, {"availableNow": True}).awaitTermination()
    first = spark.read.parquet(out)
    assert rows(first, "event_id", "kafka_offset") == [("e1", 1), ("e2", 2)]
    assert "dt" in first.columns and "_ingested_at" in first.columns
    # new files arrive; the restarted query reads only those (checkpoint)
    _land(spark, landing, [_ev(4)])
    start_ingest(file_records(spark, landing), out, ckpt, {"availableNow": True}).awaitTermination()
    assert rows(spark.read.parquet(out), "event_id") == [("e1",), ("e2",), ("e4",)]


def test_foreach_batch_routing_is_idempotent_per_batch_id(spark, tmp_dir):
    out = os.path.join(tmp_dir, "routed")
    batch = spark.createDataFrame([
        ("a", "o", "2024-01-01 00:00:00", "2024-01-01 01:00:00"),
        ("b", "o", "2024-01-01 00:00:00", "2024-01-05 00:00:00"),
    ], "event_id string, order_id string, event_time string, _ingested_at string").selectExpr(
        "event_id", "order_id", "CAST(event_time AS timestamp_ntz) AS event_time",
        "CAST(_ingested_at AS timestamp_ntz) AS _ingested_at")
    run = route_each_batch(out)
    run(batch, 0)
    run(batch, 0)  # replay of the same micro-batch
    got = spark.read.parquet(out)
    assert rows(got, "event_id", "route") == [("a", "accepted"), ("b", "rejected")]


def test_stream_to_silver_insert_only_per_batch(spark, tmp_dir):
    from datetime import datetime, timedelta, timezone
    now = datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
    on_time, late = str(now - timedelta(hours=1)), str(now - timedelta(days=30))
    landing, acc, rej, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "acc", "rej", "ckpt"))
    _land(spark, landing, [_ev(1, on_time), _ev(2, late), _ev(3, on_time)])
    sink = silver_events_sink(acc, rej)

    def go():
        q = (bronze_events(file_records(spark, landing)).drop("dt").writeStream
             .foreachBatch(sink).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
    go()
    assert rows(spark.read.parquet(acc), "event_id") == [("e1",), ("e3",)]
    assert rows(spark.read.parquet(rej), "event_id", "reject_reason") == \
        [("e2", "arrived more than 48h after event_time")]
    # a redelivered event (same id) and a new one arrive later: insert-only keeps one copy
    _land(spark, landing, [_ev(1, on_time), _ev(5, on_time)])
    go()
    assert rows(spark.read.parquet(acc), "event_id") == [("e1",), ("e3",), ("e5",)]


def test_stream_maintains_silver_orders_incrementally(spark, tmp_dir):
    from datetime import datetime, timedelta, timezone

    from strata.operators.late import stream_orders
    now = datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
    landing, acc, rej, orders, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "acc", "rej", "orders", "ckpt"))

    def ev(i, order, status, minutes):
        t = str(now - timedelta(minutes=minutes))
        return (f'{{"event_id": "e{i}", "order_id": "{order}", "customer_id": 1, "product_id": 2, '
                f'"quantity": 2, "unit_price": 1.25, "status": "{status}", "event_time": "{t}", '
                f'"produced_at": "{t}"}}', 0, i)
    sink = silver_events_sink(acc, rej, orders_path=orders)

    def go():
        q = (bronze_events(file_records(spark, landing)).drop("dt").writeStream
             .foreachBatch(sink).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
    _land(spark, landing, [ev(1, "A", "created", 50), ev(2, "B", "created", 40)])
    go()
    _land(spark, landing, [ev(3, "A", "paid", 30), ev(4, "C", "created", 20), ev(5, "A", "shipped", 35)])
    go()
    got = spark.read.parquet(orders).drop("bucket")
    full = stream_orders(spark.read.parquet(acc).drop("dt"))
    assert got.count() == 3
    assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0
    assert rows(got.filter("order_id = 'A'"), "status", "total_amount") == [("paid", 2.5)]


def test_order_buckets_are_recorded_and_another_number_is_refused(spark):
    from strata.streaming.ingest import rebucket_orders
    a, r, o = (scratch_path(spark, n) for n in ("lay_a", "lay_r", "lay_o"))
    t = ts("2024-01-01 00:00:00")
    schema = ("event_id string, order_id string, customer_id bigint, product_id bigint, quantity int, unit_price double, status string, "
              "event_time timestamp_ntz, produced_at timestamp_ntz, _ingested_at timestamp_ntz, kafka_partition int, kafka_offset bigint")
    batch = lambda e, status, hour: spark.createDataFrame(
        [(e, "o1", 1, 1, 1, 1.0, status, t.replace(hour=hour), t, t.replace(hour=hour), 0, hour)], schema)
    silver_events_sink(a, r, orders_path=o, order_buckets=8)(batch("e1", "paid", 1), 0)
    with pytest.raises(ValueError, match="8 buckets"):
        silver_events_sink(a, r, orders_path=o, order_buckets=16)(batch("e2", "shipped", 2), 1)
    silver_events_sink(a, r, orders_path=o)(batch("e2", "shipped", 2), 1)
    assert [x.status for x in spark.read.parquet(o).collect()] == ["shipped"]
    rebucket_orders(spark, o, o + "_more", 16)
    silver_events_sink(a, r, orders_path=o + "_more", order_buckets=16)(batch("e3", "completed", 3), 2)
    assert [x.status for x in spark.read.parquet(o + "_more").collect()] == ["completed"]


def test_duplicates_are_dropped_in_the_stream_across_a_restart(spark, tmp_dir):
    landing, out, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "bronze", "ckpt"))

    def go():
        start_ingest(file_records(spark, landing), out, ckpt, {"availableNow": True}, dedup_within="1 hour").awaitTermination()
    _land(spark, landing, [_ev(1, "2024-01-03 00:00:00"), _ev(1, "2024-01-03 00:00:00"), _ev(2, "2024-01-03 00:00:00")])
    go()
    # a new query over the same checkpoint: known ids stay out, an event years before the others does not
    _land(spark, landing, [_ev(1, "2024-01-03 00:00:00"), _ev(3, "2019-01-01 00:00:00")])
    go()
    assert rows(spark.read.parquet(out), "event_id") == [("e1",), ("e2",), ("e3",)]
