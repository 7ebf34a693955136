"""The query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each query reads the driver's whole tables through ``DriverTables`` and
exercises one operator (or one composition) of the library. Column names
match the DuckDB oracle in ``strata.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.incremental import changed_groups, fact_changes, refresh_daily_sales, refresh_fact
from strata.operators.keyed import snapshot_replace
from strata.operators.keys import assign_surrogate_keys, max_key
from strata.operators.late import lateness_hours, stream_orders
from strata.operators.merge import Matched, NotMatched, merge_conditional, merge_guarded, merge_insert_only, merge_upsert
from strata.operators.profile import layer_profile
from strata.operators.scd import scd2_changes, scd2_close
from strata.operators.star import asof_lookup, unknown_member
from strata.operators.star import daily_sales as daily_sales_of
from strata.operators.star import fact_orders as fact_table
from strata.plans import medallion as M
from strata.sinks.key_index import KeyIndex
from strata.sinks.partitioned import merge_into_partitions
from strata.sinks.store import materialize
from strata.sources.calendar import dim_date_covering
from strata.session import scratch_path
from strata.sources.driver_tables import RUN_AS_OF, DriverTables, ts
from strata.sources.files import typed_csv
from strata.sources.json_events import decode_json_events

Query = Callable[[SparkSession, str], DataFrame]

# Incremental load windows on the batch order arrival time.
# The older load covers arrivals before WINDOW_OLD_END, the newer one from
# WINDOW_NEW_START on; together they cover every row and overlap for a year.
WINDOW_OLD_END = "1999-01-01 00:00:00"
WINDOW_NEW_START = "1998-01-01 00:00:00"

# When the second of two runs begins, and a customer that the tables do not have.
SECOND_RUN = "1997-01-01 00:00:00"
HOT_CUSTOMER = -1


def _dt(spark, sf_dir) -> DriverTables:
    return DriverTables(spark, sf_dir)


def _older(raw: DataFrame) -> DataFrame:
    # rows without an arrival time belong to the older load
    return M.batch_orders(raw.filter((F.col("_ingested_at") < ts(WINDOW_OLD_END)) | F.col("_ingested_at").isNull()))


def _newer(raw: DataFrame) -> DataFrame:
    return M.batch_orders(raw.filter(F.col("_ingested_at") >= ts(WINDOW_NEW_START)))


def csv_typed_load(spark, sf_dir):
    """Land the raw orders as CSV files (other column order, one more column), then scan them as the batch loader does."""
    path = scratch_path(spark, "landing_orders_csv")
    raw = _dt(spark, sf_dir).orders_raw_strings()
    raw.select(*reversed(raw.columns), F.lit("x").alias("note")).write.option("header", True).csv(path)
    return typed_csv(spark, path, M.RAW_ORDERS_SCHEMA, as_of=RUN_AS_OF)


def clean_orders(spark, sf_dir):
    return M.clean_orders(_dt(spark, sf_dir).orders_raw())


def latest_customers(spark, sf_dir):
    return M.silver_customers(_dt(spark, sf_dir).customers_bronze())


def latest_products(spark, sf_dir):
    return M.silver_products(_dt(spark, sf_dir).products_bronze())


def dedup_orders(spark, sf_dir):
    return M.batch_orders(_dt(spark, sf_dir).orders_raw())


def snapshot_replace_q(spark, sf_dir):
    dt = _dt(spark, sf_dir)
    fixed = dt.customers_raw("day2").withColumn(
        "city", F.when(F.col("city") == "MOVED", F.lit("RELOCATED")).otherwise(F.col("city")))
    return snapshot_replace(dt.customers_bronze(), fixed, "snapshot", "day2")


def merge_conditional_q(spark, sf_dir):
    raw = _dt(spark, sf_dir).orders_raw()
    # a newer load already applied; an older backfill arrives afterwards
    return merge_conditional(_newer(raw), _older(raw), "order_id", "updated_at")


def merge_upsert_q(spark, sf_dir):
    raw = _dt(spark, sf_dir).orders_raw()
    return merge_upsert(_older(raw), _newer(raw), "order_id")


def merge_guarded_q(spark, sf_dir):
    raw = _dt(spark, sf_dir).orders_raw()
    target = _older(raw).withColumn(
        "source", F.when(F.col("status") == "shipped", F.lit("stream")).otherwise(F.lit("batch")))
    return merge_guarded(target, _newer(raw), "order_id", "source", "batch")


def merge_insert_only_q(spark, sf_dir):
    raw = _dt(spark, sf_dir).orders_raw()
    return merge_insert_only(_older(raw), _newer(raw), "order_id")


def json_decode(spark, sf_dir):
    return decode_json_events(_dt(spark, sf_dir).payloads())


def lateness_hours_q(spark, sf_dir):
    return lateness_hours(_dt(spark, sf_dir).order_events())


def late_accepted(spark, sf_dir):
    return M.route(_dt(spark, sf_dir).order_events()).accepted.select(*M.EVENT_COLUMNS)


def late_rejected(spark, sf_dir):
    return M.route(_dt(spark, sf_dir).order_events()).rejected.select(*M.REJECTED_COLUMNS)


def order_collapse(spark, sf_dir):
    return stream_orders(M.route(_dt(spark, sf_dir).order_events()).accepted)


def scd1_upsert(spark, sf_dir):
    dt = _dt(spark, sf_dir)
    return M.dim_product(spark, [M.silver_products(dt.products_raw(1)),
                                 M.silver_products(dt.products_bronze())])


def _day1_inputs(spark, sf_dir):
    L = M.build_layers(spark, sf_dir)
    with ThreadPoolExecutor(2) as pool:
        dim, cur = pool.map(lambda f: f(), [L.dim_customer_day1, lambda: L["silver.customers"]])
    return L, dim, cur


def scd2_changes_q(spark, sf_dir):
    L, _, _ = _day1_inputs(spark, sf_dir)
    return scd2_changes(L.dim_customer_day1(), L["silver.customers"], "customer_id", M.SCD2_TRACKED)


def scd2_close_q(spark, sf_dir):
    L, _, _ = _day1_inputs(spark, sf_dir)
    dim = L.dim_customer_day1()
    changes = scd2_changes(dim, L["silver.customers"], "customer_id", M.SCD2_TRACKED)
    return scd2_close(dim, changes, "customer_id")


def scd2_apply_q(spark, sf_dir):
    return M.build_layers(spark, sf_dir)["gold.dim_customer"]


def surrogate_keys(spark, sf_dir):
    L, _, _ = _day1_inputs(spark, sf_dir)
    start = max_key(L.dim_customer_day1(), "customer_sk")
    cust = L["silver.customers"].select("customer_id")
    return assign_surrogate_keys(cust, "customer_id", out="customer_sk", start=start)


def asof_lookup_q(spark, sf_dir):
    L = M.build_layers(spark, sf_dir)
    L.prefetch(["silver.orders", "gold.dim_customer"])
    orders = L["silver.orders"].select("order_id", "customer_id", "order_ts")
    return asof_lookup(orders, L["gold.dim_customer"], "customer_id", "order_ts", "customer_sk")


def unknown_member_q(spark, sf_dir):
    L = M.build_layers(spark, sf_dir)
    L.prefetch(["silver.orders", "gold.dim_product"])
    orders = L["silver.orders"].select("order_id", "product_id")
    return unknown_member(orders, L["gold.dim_product"], "product_id", "product_sk")


def fact_orders(spark, sf_dir):
    return M.build_layers(spark, sf_dir).unstaged("gold.fact_orders")


def dim_date(spark, sf_dir):
    return dim_date_covering(M.build_layers(spark, sf_dir)["silver.orders"], "order_ts")


def daily_sales(spark, sf_dir):
    return M.build_layers(spark, sf_dir).unstaged("gold.daily_sales")


def _dq(kinds):
    def q(spark, sf_dir):
        return M.run_stage_checks(M.build_layers(spark, sf_dir), kinds=kinds)
    return q


def _ex(kinds):
    def q(spark, sf_dir):
        return M.run_suites(M.build_layers(spark, sf_dir), kinds=kinds)
    return q


def dq_observed(spark, sf_dir):
    return M.observed_checks(M.build_layers(spark, sf_dir, observe=True))


def expect_observed(spark, sf_dir):
    return M.observed_suites(M.build_layers(spark, sf_dir, observe=True))


def layer_profile_q(spark, sf_dir):
    layers = M.build_layers(spark, sf_dir)
    layers.stage_bronze()
    layers.prefetch(layers.names())
    tables = layers.all()
    tables["audit.dq_results"] = M.run_stage_checks(tables)
    tables["audit.ge_results"] = M.run_suites(tables)
    return layer_profile(tables)


def stream_ingest(spark, sf_dir):
    from strata.streaming.ingest import ingest_payload_files_once
    return ingest_payload_files_once(spark, _dt(spark, sf_dir).payloads(), as_of=ts(RUN_AS_OF))


def stream_to_silver(spark, sf_dir):
    """Payload files → ingestion stream → bronze table → silver order states."""
    from strata.streaming.ingest import ingest_payload_files_once
    late = F.make_dt_interval(F.lit(0), (F.col("kafka_offset") % 60).cast("int"), F.lit(0), F.lit(0))
    bronze = ingest_payload_files_once(spark, _dt(spark, sf_dir).payloads(), as_of=F.col("event_time") + late)
    return stream_orders(M.route(bronze.drop("dt")).accepted)


def late_redelivered(spark, sf_dir):
    """Insert-only MERGE of two batches through the key index; the second delivers every event again, on the next day."""
    path = scratch_path(spark, "late_redelivered")
    index = KeyIndex(spark, f"{path}_keys", "event_id", ["dt"], 16)
    L = M.build_layers(spark, sf_dir)
    first = L["silver.order_events"].withColumn("dt", F.to_date("event_time"))
    again = first.withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 1 DAY")).withColumn("dt", F.to_date("event_time"))
    for batch in (first, again):
        merge_into_partitions(path, batch, "event_id", ["dt"], [], [NotMatched()], check_unique_source=False, index=index)
    return spark.read.parquet(path)


def asof_overlap(spark, sf_dir):
    """As-of lookup where closed versions run on and some customers have two open versions."""
    L = M.build_layers(spark, sf_dir)
    L.prefetch(["silver.orders", "gold.dim_customer"])
    dim = L["gold.dim_customer"]
    longer = dim.withColumn("effective_to", F.col("effective_to") + F.expr("INTERVAL 2 YEARS"))
    second = (dim.filter(F.col("is_current") & (F.col("customer_id") % 5 == 0))
                 .withColumn("customer_sk", F.col("customer_sk") + 1000000000000)
                 .withColumn("effective_from", F.col("effective_from") + F.expr("INTERVAL 1 YEAR")))
    return asof_lookup(L["silver.orders"].select("order_id", "customer_id", "order_ts"), longer.unionByName(second),
                       "customer_id", "order_ts", "customer_sk")


def asof_many_versions(spark, sf_dir):
    """As-of lookup where one customer has a version for every order of the table (each two days long) and a third of the facts."""
    L = M.build_layers(spark, sf_dir)
    L.prefetch(["silver.orders", "gold.dim_customer"])
    o = _dt(spark, sf_dir).table("orders")
    start = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("o_orderkey") % 86400).cast("decimal(18,6)"))
    hot = o.select((F.col("o_orderkey") + 2000000000000).alias("customer_sk"), F.lit(HOT_CUSTOMER).cast("long").alias("customer_id"),
                   start.alias("effective_from"), (start + F.expr("INTERVAL 2 DAYS")).alias("effective_to"))
    dim = L["gold.dim_customer"].select(*hot.columns).unionByName(hot)
    who = F.when(F.col("quantity") % 3 == 0, F.lit(HOT_CUSTOMER)).otherwise(F.col("customer_id"))
    facts = L["silver.orders"].select("order_id", who.cast("long").alias("customer_id"), "order_ts")
    return asof_lookup(facts, dim, "customer_id", "order_ts", "customer_sk")


def _two_runs(spark, sf_dir):
    """Layers after the second run, and what the first run had: fewer orders, some in another
    status, the first customer versions and nine tenths of the products at their first prices."""
    L = M.build_layers(spark, sf_dir)
    L.prefetch(["silver.orders", "gold.dim_customer", "gold.dim_product"])
    late = (F.col("updated_at") >= ts(SECOND_RUN)) | (F.col("quantity") % 7 == 0)
    orders = L["silver.orders"]
    before = orders.filter(F.col("updated_at") < ts(SECOND_RUN)).withColumn("status", F.when(late, F.lit("created")).otherwise(F.col("status")))
    products = M.dim_product(spark, [M.silver_products(_dt(spark, sf_dir).products_raw(1))]).filter("product_id % 10 <> 0")
    fact = materialize(fact_table(before, L.dim_customer_day1(), products), "fact_run1")
    changes = fact_changes(orders, orders.filter(late), L.dim_customer_day1(), L["gold.dim_customer"], products, L["gold.dim_product"])
    return L, products, fact, changes


def fact_incremental(spark, sf_dir):
    """The first run's fact with the changes of the second: equal to a full build."""
    _, _, fact, changes = _two_runs(spark, sf_dir)
    return refresh_fact(fact, changes)


def daily_sales_incremental(spark, sf_dir):
    """The first run's mart with the groups that the second run touched computed again."""
    L, products, fact, changes = _two_runs(spark, sf_dir)
    mart = materialize(daily_sales_of(fact, products), "mart_run1")
    groups = changed_groups(fact, changes, products, L["gold.dim_product"])
    return refresh_daily_sales(mart, refresh_fact(fact, changes), L["gold.dim_product"], groups)


def order_state_incremental(spark, sf_dir):
    """Order states folded batch by batch in the streaming sink: three shuffled batches, then the first again with other values."""
    from strata.streaming.ingest import silver_events_sink
    root = scratch_path(spark, "order_state")
    sink = silver_events_sink(f"{root}/accepted", f"{root}/rejected", M.LATE_LIMIT_HOURS, orders_path=f"{root}/orders", order_buckets=8, key_buckets=8)
    events = _dt(spark, sf_dir).order_events()
    nth = F.col("event_id").cast("long") % 3
    again = (events.filter(nth == 0).withColumn("status", F.lit("again")).withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 3 DAYS"))
                   .withColumn("_ingested_at", F.col("_ingested_at") + F.expr("INTERVAL 3 DAYS")))
    for i, batch in enumerate([events.filter(nth == 0), events.filter(nth == 2), events.filter(nth == 1), again]):
        sink(batch, i)
    return spark.read.parquet(f"{root}/orders").select(*M.ORDER_COLUMNS)


def partitioned_merge(spark, sf_dir):
    """MERGE of one year's orders into a table of two partition columns (month, customer bucket) with over 1 000 partitions:
    returned ones deleted, others updated, missing ones inserted."""
    path = scratch_path(spark, "partitioned_merge")
    o = _dt(spark, sf_dir).table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM").alias("month"),
                                                  (F.col("o_custkey") % 16).cast("int").alias("part"))
    rows = lambda skip: o.filter(F.col("o_orderkey") % skip != 0)
    merge_into_partitions(path, rows(5), "o_orderkey", ["month", "part"], [Matched()], [NotMatched()])
    year = materialize(rows(3).filter(F.col("month").startswith("1996")).withColumn("o_totalprice", F.col("o_totalprice") + 1), "year")
    merge_into_partitions(path, year, "o_orderkey", ["month", "part"],
                          [Matched(cond=lambda t, s: s["o_orderstatus"] == "F", delete=True), Matched(update={"o_totalprice": lambda t, s: s["o_totalprice"]})],
                          [NotMatched()])
    return spark.read.parquet(path).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.col("month").cast("string").alias("month"), "part")


def surrogate_keys_skewed(spark, sf_dir):
    """Dense keys over customer ids with outliers beyond ±2^62."""
    c, far = F.col("c_custkey"), F.lit(1 << 62)
    k = F.when(c % 1000 == 0, far + c).when(c % 1000 == 1, -far - c).otherwise(c)
    return assign_surrogate_keys(_dt(spark, sf_dir).table("customer").select(k.alias("k")), "k")


def queries() -> dict[str, Query]:
    return {
        "csv_typed_load": csv_typed_load,
        "clean_orders": clean_orders,
        "latest_customers": latest_customers,
        "latest_products": latest_products,
        "dedup_orders": dedup_orders,
        "snapshot_replace": snapshot_replace_q,
        "merge_conditional": merge_conditional_q,
        "merge_upsert": merge_upsert_q,
        "merge_guarded": merge_guarded_q,
        "merge_insert_only": merge_insert_only_q,
        "json_decode": json_decode,
        "lateness_hours": lateness_hours_q,
        "late_accepted": late_accepted,
        "late_rejected": late_rejected,
        "order_collapse": order_collapse,
        "scd1_upsert": scd1_upsert,
        "scd2_changes": scd2_changes_q,
        "scd2_close": scd2_close_q,
        "scd2_apply": scd2_apply_q,
        "surrogate_keys": surrogate_keys,
        "asof_lookup": asof_lookup_q,
        "unknown_member": unknown_member_q,
        "fact_orders": fact_orders,
        "dim_date": dim_date,
        "daily_sales": daily_sales,
        "dq_not_empty": _dq({"not_empty"}),
        "dq_null_keys": _dq({"null_keys"}),
        "dq_duplicates": _dq({"duplicates"}),
        "dq_predicate": _dq({"predicate"}),
        "dq_ref_integrity": _dq({"ref_integrity"}),
        "dq_single_current": _dq({"single_current"}),
        "dq_report": _dq(None),
        "expect_not_null": _ex({"expect_column_values_to_not_be_null"}),
        "expect_unique": _ex({"expect_column_values_to_be_unique"}),
        "expect_between": _ex({"expect_column_values_to_be_between"}),
        "expect_in_set": _ex({"expect_column_values_to_be_in_set"}),
        "expect_row_count": _ex({"expect_table_row_count_to_be_between"}),
        "expect_report": _ex(None),
        "layer_profile": layer_profile_q,
        "stream_ingest": stream_ingest,
        "stream_to_silver": stream_to_silver,
        "late_redelivered": late_redelivered,
        "asof_overlap": asof_overlap,
        "surrogate_keys_skewed": surrogate_keys_skewed,
        "asof_many_versions": asof_many_versions,
        "order_state_incremental": order_state_incremental,
        "partitioned_merge": partitioned_merge,
        "fact_incremental": fact_incremental,
        "daily_sales_incremental": daily_sales_incremental,
        "dq_observed": dq_observed,
        "expect_observed": expect_observed,
    }


__all__ = ["queries"]
