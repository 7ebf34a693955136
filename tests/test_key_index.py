"""The key index, the pruned partition MERGE and the incremental order state under broken-off and repeated batches."""

import os

import pytest

from conftest import rows, ts
from strata.operators.late import fold_states, order_state, orders_of, stream_orders
from strata.operators.merge import Matched, NotMatched
from strata.session import scratch_path, scratch_scope
from strata.sinks import partitioned, store
from strata.sinks.key_index import KeyIndex
from strata.sinks.partitioned import merge_into_partitions, touched_rows
from strata.streaming import ingest
from strata.streaming.ingest import silver_events_sink

S = "id string, v string, d string"
EVENT = ("event_id string, order_id string, customer_id bigint, product_id bigint, quantity int, unit_price double, status string, "
         "event_time timestamp_ntz, produced_at timestamp_ntz, _ingested_at timestamp_ntz, kafka_partition int, kafka_offset bigint")


def test_insert_only_through_the_index(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    index = KeyIndex(spark, path + "_keys", "id", ["d"], 4)
    put = lambda *r: merge_into_partitions(path, spark.createDataFrame(list(r), S), "id", ["d"], [], [NotMatched()], index=index)
    put(("a", "1", "x"), ("b", "1", "y"), (None, "n", "x"))
    put(("a", "again", "z"), ("c", "1", "z"), (None, "n", "x"))
    put(("c", "again", "x"))
    assert rows(spark.read.schema(S).parquet(path)) == sorted([("a", "1", "x"), ("b", "1", "y"), ("c", "1", "z"), (None, "n", "x"), (None, "n", "x")], key=repr)
    with pytest.raises(ValueError, match="4 buckets"):
        KeyIndex(spark, path + "_keys", "id", ["d"], 8)
    index.add(spark.createDataFrame([("a", "1", "x")], S))  # entered twice
    index.compact()
    assert rows(spark.read.parquet(index.path), "id", "d") == [("a", "x"), ("b", "y"), ("c", "z")]


def test_a_key_whose_row_was_never_written_is_new(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    index = KeyIndex(spark, path + "_keys", "id", ["d"], 2)
    merge_into_partitions(path, spark.createDataFrame([("a", "1", "x")], S), "id", ["d"], [], [NotMatched()], index=index)
    lost = spark.createDataFrame([("b", "1", "x"), ("a", "1", "x")], S)
    index.add(lost)  # a batch that died between its keys and its rows
    merge_into_partitions(path, lost, "id", ["d"], [], [NotMatched()], index=index)
    assert rows(spark.read.schema(S).parquet(path), "id") == [("a",), ("b",)]


def test_an_index_beside_an_older_table_knows_its_keys(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    spark.createDataFrame([("a", "1", "x")], S).write.partitionBy("d").parquet(path)
    spark.createDataFrame([("zz", "1", "x", 0)], S + ", bucket int").write.partitionBy("bucket").parquet(path + "_keys")  # of a broken-off build
    index = KeyIndex.beside(spark, path, "id", ["d"])
    assert rows(spark.read.parquet(index.path), "id") == [("a",)]
    assert index.unseen(spark.createDataFrame([("a", "2", "y"), ("b", "1", "y")], S), path).collect()[0].id == "b"


def test_keys_of_ended_writes_are_known_without_the_table(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    index = KeyIndex(spark, path + "_keys", "id", ["d"], 4)
    put = lambda *r: merge_into_partitions(path, spark.createDataFrame(list(r), S), "id", ["d"], [], [NotMatched()], index=index)
    put(("a", "1", "x"), ("b", "1", "y"))
    put(("c", "1", "x"), ("b", "2", "z"))
    again = spark.createDataFrame([("a", "2", "z"), ("b", "2", "x"), ("c", "2", "y"), ("e", "1", "x"), (None, "n", "x")], S)
    assert store.names(spark, index.path + "_open") == []
    for folder, _, files in os.walk(path):  # no file of the table can be read any more
        for f in files:
            if f.endswith(".parquet"):
                with open(os.path.join(folder, f), "wb") as out:
                    out.write(b"nothing")
    assert rows(index.unseen(again, path), "id") == [("e",), (None,)]


def test_keys_of_broken_off_and_unnamed_writes_are_looked_up(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    index = KeyIndex(spark, path + "_keys", "id", ["d"], 4)
    merge_into_partitions(path, spark.createDataFrame([("a", "1", "x"), ("b", "1", "y")], S), "id", ["d"], [], [NotMatched()], index=index)
    lost = spark.createDataFrame([("a", "1", "x"), ("c", "1", "y")], S)
    index.add(lost)  # never settled
    # entries from before writes had names: of a row and of none
    store.append(index._entries(spark.createDataFrame([("b", "1", "y"), ("f", "1", "x")], S)), index.path, partition_by=["bucket"])
    batch = spark.createDataFrame([(k, "2", "z") for k in "abcfg"], S)
    for _ in range(2):
        assert rows(index.unseen(batch, path), "id") == [("c",), ("f",), ("g",)]
        index.compact()
        assert store.names(spark, index.path + "_open") == []
    index.settle(index.add(lost))
    assert rows(index.unseen(batch, path), "id") == [("f",), ("g",)]


def test_the_sink_settles_its_writes(spark, tmp_dir, monkeypatch):
    acc, rej, orders = (os.path.join(tmp_dir, x) for x in ("acc", "rej", "orders"))
    sink = silver_events_sink(acc, rej, orders_path=orders, order_buckets=4, key_buckets=4)
    marks = lambda: [len(store.names(spark, f"{x}_keys_open")) for x in (acc, rej)]
    sink(_events(spark, *BATCHES[0]), 0)
    assert marks() == [0, 0]

    def dies(*a, **k):
        raise KeyboardInterrupt
    monkeypatch.setattr(ingest, "append", dies)
    with pytest.raises(KeyboardInterrupt):
        sink(_events(spark, *BATCHES[1]), 1)
    assert marks() == [1, 0]
    monkeypatch.undo()
    sink(_events(spark, *BATCHES[1]), 1)
    assert marks() == [1, 0]
    assert rows(spark.read.parquet(acc), "event_id") == [("e1",), ("e2",), ("e3",), ("e4",)]


def test_scans_are_pruned_while_they_run(spark, tmp_dir):
    path = os.path.join(tmp_dir, "wide")
    df = spark.range(1200).selectExpr("id", "cast(id / 30 as int) a", "cast(id % 30 as int) b", "'x' v").coalesce(1)
    merge_into_partitions(path, df, "id", ["a", "b"], [Matched()], [NotMatched()])
    source = df.filter("id = 7 OR id = 65").withColumn("v", df.v)
    near, _ = touched_rows(path, source, ["a", "b"])
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and " IN (" not in plan
    near.collect()
    read = [int(x.split(":")[1]) for x in _metrics(near, "numPartitions")]
    assert read and max(read) <= 4  # (0, 7), (0, 5), (2, 7), (2, 5) of 1 200
    index = KeyIndex(spark, os.path.join(tmp_dir, "keys"), "id", ["a"], 50)
    index.add(df)
    found = index.candidates(source)
    assert rows(found, "id") == [(7,), (65,)] or rows(found, "id") == [(65,), (7,)]
    assert max(int(x.split(":")[1]) for x in _metrics(found, "numPartitions")) <= 2


def _metrics(df, name):
    """``name:value`` of every file scan of the executed plan."""
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.finalPhysicalPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        m = node.metrics().get(name)
        if kind == "FileSourceScanExec" and m.isDefined():
            out.append(f"{name}:{m.get().value()}")
        children = node.children()
        todo += [children.apply(i) for i in range(children.length())]
    return out


def _events(spark, *specs):
    t = ts("2024-01-01 00:00:00")
    return spark.createDataFrame([(e, o, 1, 1, q, 1.0, st, t.replace(hour=h), t, t.replace(hour=h), 0, h) for e, o, q, st, h in specs], EVENT)


BATCHES = [[("e1", "A", 1, "created", 5), ("e2", "B", 1, "created", 6), ("e0", None, 1, "paid", 1)],
           [("e3", "A", 2, "paid", 3), ("e4", "C", 1, "created", 7), ("e1", "A", 9, "changed", 23)],  # e3 is older; e1 comes again, changed
           [("e5", "A", 3, "shipped", 9), ("e6", "B", 1, "paid", 2)]]


def _state_of(spark, orders, accepted):
    got = spark.read.parquet(orders).drop("bucket")
    full = stream_orders(spark.read.parquet(accepted).drop("dt"))
    assert got.exceptAll(full).isEmpty() and full.exceptAll(got).isEmpty()
    return rows(got, "order_id", "quantity", "status")


def test_states_fold_in_any_order_and_twice(spark):
    parts = [order_state(_events(spark, *b)) for b in ([("e1", "A", 1, "x", 5)], [("e2", "A", 2, "y", 3), ("e3", "B", 1, "z", 1)], [("e4", "A", 5, "w", 8)])]
    want = rows(orders_of(order_state(_events(spark, ("e1", "A", 1, "x", 5), ("e2", "A", 2, "y", 3), ("e3", "B", 1, "z", 1), ("e4", "A", 5, "w", 8)))))
    assert rows(orders_of(fold_states(*parts))) == rows(orders_of(fold_states(parts[2], fold_states(parts[1], parts[0]), parts[1]))) == want


def test_batches_read_no_history(spark, tmp_dir, monkeypatch):
    acc, rej, orders = (os.path.join(tmp_dir, x) for x in ("acc", "rej", "orders"))
    sink = silver_events_sink(acc, rej, orders_path=orders, order_buckets=8, key_buckets=8)
    sink(_events(spark, *BATCHES[0]), 0)
    # the accepted history becomes unreadable: a batch of new events does not notice
    read = []
    real = ingest.order_state
    monkeypatch.setattr(ingest, "order_state", lambda df, *a: (read.append(df.inputFiles()), real(df, *a))[1])
    sink(_events(spark, ("e7", "A", 7, "late", 1), ("e8", "D", 1, "new", 2)), 1)
    assert read and not [f for files in read for f in files if "/acc/" in f]
    monkeypatch.undo()
    sink(_events(spark, *BATCHES[1]), 2)
    sink(_events(spark, *BATCHES[2]), 3)
    assert _state_of(spark, orders, acc) == [("A", 3, "shipped"), ("B", 1, "created"), ("C", 1, "created"), ("D", 1, "new")]


@pytest.mark.parametrize("step", ["keys", "orders", "events"])
def test_a_batch_that_dies_and_comes_again(spark, tmp_dir, monkeypatch, step):
    acc, rej, orders = (os.path.join(tmp_dir, x) for x in ("acc", "rej", "orders"))
    sink = silver_events_sink(acc, rej, orders_path=orders, order_buckets=4, key_buckets=4, ledger_root=tmp_dir)
    sink(_events(spark, *BATCHES[0]), 0)

    def dies(*a, **k):
        raise KeyboardInterrupt(step)
    if step == "keys":
        monkeypatch.setattr(ingest, "fold_orders", dies)
    elif step == "state":
        real = ingest.merge_into_partitions
        monkeypatch.setattr(ingest, "merge_into_partitions", lambda path, *a, **k: dies() if path == orders else real(path, *a, **k))
    elif step == "orders":
        monkeypatch.setattr(ingest, "append", dies)
    elif step == "events":
        monkeypatch.setattr(ingest.Ledger, "finish", dies)
    if step != "none":
        with pytest.raises(KeyboardInterrupt):
            sink(_events(spark, *BATCHES[1]), 1)
        monkeypatch.undo()
    sink(_events(spark, *BATCHES[1]), 1)
    sink(_events(spark, *BATCHES[2]), 2)
    sink(_events(spark, *BATCHES[2]), 2)  # the ledger has it
    assert rows(spark.read.parquet(acc), "event_id") == [("e1",), ("e2",), ("e3",), ("e4",), ("e5",), ("e6",)]
    assert _state_of(spark, orders, acc) == [("A", 3, "shipped"), ("B", 1, "created"), ("C", 1, "created")]


def test_a_broken_off_append_publishes_nothing_later(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    one = spark.createDataFrame([("a", "1", "x")], S)
    one.write.partitionBy("d").parquet(path + "_other")
    # a finished task of a job that never committed
    os.makedirs(f"{path}/_temporary/0")
    os.rename(path + "_other", f"{path}/_temporary/0/task_202401010000000000000_0001_m_000000")
    assert not store.has_data(spark, path)
    merge_into_partitions(path, one, "id", ["d"], [Matched()], [NotMatched()])
    assert spark.read.parquet(path).count() == 1


def test_staged_data_is_released_by_batch(spark, tmp_dir):
    from strata import session
    acc, rej = (os.path.join(tmp_dir, x) for x in ("acc", "rej"))
    sink = silver_events_sink(acc, rej, orders_path=os.path.join(tmp_dir, "o"), order_buckets=2, key_buckets=2)
    before = {p for _, p in session._SCRATCH}
    root = session.checkpoint_root(spark) + "/strata"
    held = set(os.listdir(root)) if os.path.isdir(root) else set()
    for i in range(3):
        sink(_events(spark, (f"x{i}", "A", i, "s", i)), i)
    assert {p for _, p in session._SCRATCH} == before
    assert set(os.listdir(root)) == held
    with pytest.raises(ZeroDivisionError), scratch_scope():
        spark.range(1).write.parquet(scratch_path(spark, "gone"))
        1 / 0
    assert set(os.listdir(root)) == held
    assert partitioned.KeyIndex is KeyIndex
