"""Structured Streaming ingestion of JSON order events into bronze.

Source: any stream of message records with ``value`` (bytes or string),
``partition`` and ``offset`` — a Kafka topic on a cluster, or a file stream
of such records offline (the Kafka connector is not on this classpath).
Sink: an append-only parquet table laid out by event day, made exactly-once
by the checkpoint plus the file sink's commit log.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.operators.late import ROUTE, fold_clause, order_state, orders_of, route_events
from strata.operators.merge import Matched, NotMatched
from strata.sinks.key_index import KeyIndex
from strata.sinks.ledger import Ledger
from strata.sinks.partitioned import merge_into_partitions, touched_rows
from strata.sinks.store import append, has_data, materialize, path_exists, recorded_number
from strata.session import scratch_path, scratch_scope
from strata.sources.json_events import ORDER_EVENT_SCHEMA, decode_json_events

RECORD_SCHEMA = "value string, partition int, offset bigint"

# Bronze order-event column order.
BRONZE_EVENT_COLUMNS = ["event_id", "order_id", "customer_id", "product_id", "quantity", "unit_price",
                        "status", "event_time", "produced_at", "_ingested_at", "kafka_partition",
                        "kafka_offset"]


def kafka_records(spark: SparkSession, bootstrap: str, topic: str) -> DataFrame:
    """Kafka source (needs the spark-sql-kafka package on the cluster)."""
    return (spark.readStream.format("kafka")
                 .option("kafka.bootstrap.servers", bootstrap)
                 .option("subscribe", topic)
                 .option("startingOffsets", "earliest")
                 .option("failOnDataLoss", "false")
                 .load())


def file_records(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """File stream of message records (parquet files with ``RECORD_SCHEMA``)."""
    r = spark.readStream.schema(RECORD_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def bronze_events(records: DataFrame, as_of=None, dedup_within: str | None = None) -> DataFrame:
    """Decode, drop unparseable records, stamp arrival time, fix column order, add ``dt``.

    The arrival stamp is the micro-batch clock, or ``as_of`` when a run
    clock is pinned (reproducible runs and checks).

    ``dedup_within`` (e.g. ``"1 hour"``) keeps an event that was delivered again
    within that time out of the stream. The time is that of arrival, not of the
    event: no row is ever too late for it, so late events still reach the
    lateness rule, and the state holds the ids of that time alone. Later redeliveries
    are left to the insert-only MERGE behind.
    """
    ev = decode_json_events(records, ORDER_EVENT_SCHEMA, key="event_id")
    if dedup_within is not None:
        ev = (ev.withColumn("__arrived", F.current_timestamp()).withWatermark("__arrived", dedup_within)
                .dropDuplicatesWithinWatermark(["event_id"]).drop("__arrived"))
    stamp = as_of if as_of is not None else F.current_timestamp().cast("timestamp_ntz")
    ev = ev.withColumn("_ingested_at", stamp)
    return ev.select(*BRONZE_EVENT_COLUMNS).withColumn("dt", F.to_date("event_time"))


def start_ingest(records: DataFrame, out: str, checkpoint: str, trigger: dict | None = None,
                 as_of=None, dedup_within: str | None = None) -> StreamingQuery:
    """Append decoded events to ``out`` partitioned by event day.

    ``trigger`` is passed to ``DataStreamWriter.trigger`` (e.g.
    ``{"processingTime": "30 seconds"}``, or ``{"availableNow": True}``);
    ``dedup_within`` to ``bronze_events``.
    """
    w = (bronze_events(records, as_of, dedup_within).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).partitionBy("dt"))
    w = w.trigger(**(trigger or {"processingTime": "30 seconds"}))
    return w.start(out)


def route_each_batch(out: str, limit_hours: float = 48) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body applying the lateness split to every micro-batch.

    Each batch is written to ``out/batch=<id>`` partitioned by route with
    overwrite, so a replayed batch id rewrites the same folder (idempotent).
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        routed = route_events(batch, limit_hours=limit_hours).routed
        (routed.write.mode("overwrite").partitionBy(ROUTE)
               .parquet(f"{out.rstrip('/')}/batch={batch_id}"))
    return run


def _bucket(n: int):
    return F.pmod(F.xxhash64("order_id"), F.lit(n)).cast("int")


def _layout(spark: SparkSession, orders_path: str, buckets: int | None, default: int) -> int:
    """The recorded bucket count of the table; recorded now if the table is new."""
    if not path_exists(spark, f"{orders_path.rstrip('/')}_layout/_SUCCESS") and has_data(spark, orders_path):
        raise ValueError(f"{orders_path} has no recorded bucket count; copy it with rebucket_orders")
    return recorded_number(spark, orders_path, buckets, default)


def _state_path(orders_path: str) -> str:
    return orders_path.rstrip("/") + "_state"


def rebucket_orders(spark: SparkSession, orders_path: str, new_path: str, buckets: int) -> None:
    """Copy the bucketed order table and its state to ``new_path`` with another number of buckets (recorded there)."""
    if path_exists(spark, new_path):
        raise ValueError(f"{new_path} exists")
    n = _layout(spark, new_path, buckets, buckets)
    for old, new in ((orders_path, new_path), (_state_path(orders_path), _state_path(new_path))):
        if has_data(spark, old):
            spark.read.parquet(old).withColumn("bucket", _bucket(n)).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(new)


def fold_orders(spark: SparkSession, orders_path: str, new: DataFrame, buckets: int, history: DataFrame | None = None) -> None:
    """Fold ``new`` events into the stored state of their orders and upsert those orders.

    Reads and rewrites the buckets of the touched orders, no earlier event.
    ``history`` is folded first where the orders are older than their state table.
    Folding the same events again changes nothing.
    """
    state_path = _state_path(orders_path)
    if history is not None and not has_data(spark, state_path):
        older = materialize(order_state(history).withColumn("bucket", _bucket(buckets)), "older_state")
        merge_into_partitions(state_path, older, "order_id", ["bucket"], [], [NotMatched()], check_unique_source=False)
    state = materialize(order_state(new).withColumn("bucket", _bucket(buckets)), "batch_state")
    merge_into_partitions(state_path, state, "order_id", ["bucket"], [fold_clause()], [NotMatched()], check_unique_source=False)
    near, _ = touched_rows(state_path, state, ["bucket"])
    folded = near.join(state.select("order_id", "bucket"), ["order_id", "bucket"], "left_semi")
    orders = orders_of(folded).withColumn("bucket", _bucket(buckets))
    merge_into_partitions(orders_path, materialize(orders, "batch_orders"), "order_id", ["bucket"], [Matched()], [NotMatched()], check_unique_source=False)


def silver_events_sink(accepted_path: str, rejected_path: str, limit_hours: float = 48,
                       key: str = "event_id", orders_path: str | None = None,
                       order_buckets: int | None = None, order_bytes: int = 64 << 30,
                       key_buckets: int | None = None, ledger_root: str | None = None,
                       stream: str = "stream") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: lateness split, then insert-only MERGE per micro-batch.

    Accepted and quarantined events go to tables partitioned by event day. Which
    events are stored already is asked of a key index beside each table
    (``key_buckets`` buckets, recorded), so a batch reads the buckets of its own
    keys. A replayed batch, or an event delivered twice, is a no-op — the stream's
    exactly-once guarantee does not have to reach into the silver tables.

    With ``orders_path``, the batch's new events are folded into a stored state per
    order and the touched orders upserted into ``silver.orders``; both tables
    are laid out in hash buckets of ``order_id``, so a batch reads and rewrites the
    buckets of its orders and no history. Their number is recorded
    beside the table when it is first written: ``order_buckets``, or one per
    GiB of ``order_bytes``, the size the table is expected to reach. Another
    ``order_buckets`` later is refused (``rebucket_orders`` copies a table).

    Steps follow in this order: keys, states, orders, events. Whatever breaks off, the
    events that are not in their table yet are new again when the batch is
    replayed, and the earlier steps repeat without effect. With ``ledger_root`` a
    replay also skips the tables that the batch had finished; ``stream`` names
    the checkpoint (a new checkpoint counts batches from 0 again and needs a new name).
    What a batch stages is deleted when it ends.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ledger = Ledger(spark, ledger_root, f"{stream}-{batch_id}") if ledger_root else None
        done = lambda table: ledger is not None and ledger.finished(table) is not None
        if done("accepted") and done("rejected"):
            return
        with scratch_scope():
            r = route_events(batch, limit_hours=limit_hours, key=key,
                             rejected_at=F.current_timestamp().cast("timestamp_ntz"))
            routed = r.over(materialize(r.routed, f"routed_batch_{batch_id}"))
            if not done("accepted"):
                index = KeyIndex.beside(spark, accepted_path, key, ["dt"], key_buckets)
                new = materialize(index.unseen(routed.accepted.withColumn("dt", F.to_date("event_time")), accepted_path), "new_events")
                if not new.isEmpty():
                    write = index.add(new)
                    if orders_path is not None:
                        buckets = _layout(spark, orders_path, order_buckets, max(1, order_bytes >> 30))
                        # the events are listed only for a table of orders that is older than its states
                        older = not has_data(spark, _state_path(orders_path)) and has_data(spark, accepted_path)
                        history = spark.read.parquet(accepted_path) if older else None
                        fold_orders(spark, orders_path, new, buckets, history)
                    append(new, accepted_path, partition_by=["dt"])
                    index.settle(write)
                if ledger is not None:
                    ledger.finish("accepted", accepted_path)
            if not done("rejected"):
                late = routed.rejected.withColumn("dt", F.to_date("event_time"))
                merge_into_partitions(rejected_path, late, key, ["dt"], [], [NotMatched()], check_unique_source=False,
                                      index=KeyIndex.beside(spark, rejected_path, key, ["dt"], key_buckets))
                if ledger is not None:
                    ledger.finish("rejected", rejected_path)
    return run


def ingest_payload_files_once(spark: SparkSession, records: DataFrame, as_of=None) -> DataFrame:
    """Land ``records`` as files, run the ingest stream to completion, read bronze back.

    Folders are fresh paths under the session's checkpoint folder.
    """
    landing = scratch_path(spark, "landing")
    out = scratch_path(spark, "bronze_order_events")
    ckpt = scratch_path(spark, "ckpt_order_events")
    records.select("value", "partition", "offset").write.parquet(landing)
    q = start_ingest(file_records(spark, landing), out, ckpt, {"availableNow": True}, as_of)
    q.awaitTermination()
    return spark.read.parquet(out)
