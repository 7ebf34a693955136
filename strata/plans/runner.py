"""Stage runner: one medallion run per snapshot, with state carried between runs.

``run_pipeline(spark, inputs, root, snapshot)`` takes the user's CSV files or
DataFrames, and the events from a DataFrame, a table or the folder that the
ingestion stream fills; ``run_medallion(spark, sf_dir, root, snapshot)`` takes
the driver's tables. A run does what the scheduled
chain of jobs does — seed bronze → gate → silver → gate → gold → gate →
expectations — against tables stored under ``root`` (a folder in the shared
storage). Every replaced table is written as a new version folder, so a run never
overwrites a path it is reading, and a failed run leaves the previous
versions intact. The event history tables grow in place by appends
(insert-only MERGE into day partitions). Running the same snapshot twice yields the same tables
(the run clock is a parameter).
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators import expectations as ex
from strata.operators import quality as dq
from strata.operators.keyed import snapshot_replace
from strata.operators.merge import NotMatched, merge_conditional, merge_upsert
from strata.operators.scd import scd1, scd2_apply
from strata.operators.star import daily_sales, fact_orders
from strata.plans import medallion as M
from strata.sinks import store
from strata.sinks.key_index import KeyIndex
from strata.sinks.ledger import Ledger
from strata.sinks.partitioned import merge_into_partitions
from strata.sources.calendar import dim_date, dim_date_covering
from strata.sources.driver_tables import DriverTables, ts
from strata.sources.files import typed_csv
from strata.sources.json_events import ORDER_EVENT_SCHEMA
from strata.streaming.ingest import BRONZE_EVENT_COLUMNS

SNAPSHOTS = ("day1", "day2")

DQ_RESULTS_SCHEMA = M.flat_schema("run_ts timestamp_ntz, stage string, check_name string, severity string, "
                                  "violations bigint, passed boolean")
GE_RESULTS_SCHEMA = M.flat_schema("run_ts timestamp_ntz, table_name string, expectation string, kwargs string, "
                                  "success boolean, observed bigint")


EVENTS_SCHEMA = StructType([*ORDER_EVENT_SCHEMA.fields, *M.flat_schema("_ingested_at timestamp_ntz, lateness_hours double").fields])
REJECTED_SCHEMA = StructType([*EVENTS_SCHEMA.fields, *M.flat_schema("reject_reason string, rejected_at timestamp_ntz").fields])
BRONZE_EVENTS_SCHEMA = StructType([*ORDER_EVENT_SCHEMA.fields, *M.flat_schema(
    "_ingested_at timestamp_ntz, kafka_partition int, kafka_offset bigint, dt date").fields])


#: Tables that grow in place, with the schema they have while they are empty.
GROWING = {"bronze.order_events": BRONZE_EVENTS_SCHEMA, "silver.order_events": EVENTS_SCHEMA, "silver.order_events_rejected": REJECTED_SCHEMA}


@dataclass
class RunResult:
    root: str
    snapshot: str
    as_of: str
    tables: dict[str, DataFrame] = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)
    rows_written: dict[str, int] = field(default_factory=dict)


class _Store:
    """Tables under ``root``. With a ledger, a table that the run has finished is read, not built again."""

    def __init__(self, spark: SparkSession, root: str, counts: dict[str, int], ledger: Ledger | None = None):
        self.spark, self.root, self.counts, self.ledger = spark, root.rstrip("/"), counts, ledger

    def path(self, name: str) -> str:
        layer, _, table = name.partition(".")
        return f"{self.root}/{layer}/{table}"

    def read(self, name: str, schema=None) -> DataFrame:
        return store.read_latest(self.spark, self.path(name), schema)

    def finished(self, name: str) -> bool:
        return self.ledger is not None and self.ledger.finished(name) is not None

    def finish(self, name: str) -> None:
        if self.ledger is not None:
            self.ledger.finish(name)

    def replace(self, name: str, make: Callable[[], DataFrame], partition_by=None) -> DataFrame:
        """A new version of the table from ``make()``."""
        done = self.ledger.finished(name) if self.ledger is not None else None
        if done is not None and store.has_data(self.spark, done["path"]):
            self.counts[name] = done["rows"]
            return self.spark.read.parquet(done["path"])
        df = make()
        if done is None:
            path = store.next_version(self.spark, self.path(name))
            if self.ledger is not None:
                self.ledger.begin(name, path)
            # row count collected by the write job itself (no second scan)
            obs = Observation(name)
            store.write_version(df.observe(obs, F.count(F.lit(1)).alias("rows")), self.path(name), partition_by, path)
            done = {"path": path, "rows": int(obs.get["rows"])}
            if self.ledger is not None:
                self.ledger.finish(name, **done)
        self.counts[name] = done["rows"]
        return store.read_as(self.spark, done["path"], df.schema)

    def read_table(self, name: str, schema: StructType | None = None) -> DataFrame:
        """An in-place (appended / partition-merged) table; one that never received a row is empty, of this schema."""
        if schema is not None and not store.has_data(self.spark, self.path(name)):
            return M.empty(self.spark, schema)
        return self.spark.read.parquet(self.path(name))

    def append(self, name: str, df: DataFrame) -> DataFrame:
        path = self.path(name)
        store.append(df, path)
        return self.spark.read.parquet(path)


def _audited(s: _Store, name: str, results: DataFrame, same: Column) -> DataFrame:
    """Append a few audit rows in one file, once a run: a retry finds the rows of ``same`` there."""
    if s.ledger is not None and store.has_data(s.spark, s.path(name)) and not s.read_table(name).filter(same).isEmpty():
        return s.read_table(name)
    return s.append(name, results.coalesce(1))


def _checks(s: _Store, tables: dict[str, DataFrame], stage: str, run_ts: Column, r: RunResult) -> None:
    """Run the stage's checks once, append them to the audit trail, then gate on them.

    Passed checks are not run again when a run is retried; failed ones are, and stop the retry too.
    """
    if s.finished(f"checks.{stage}"):
        return
    results = store.materialize(dq.run_checks(tables, M.checks()[stage], stage, run_ts)
                                .select(*DQ_RESULTS_SCHEMA.fieldNames()), f"dq_{stage}")
    _audited(s, "audit.dq_results", results, (F.col("run_ts") == run_ts) & (F.col("stage") == stage))
    r.warnings += dq.gate(results, stage)
    s.finish(f"checks.{stage}")


def _parallel(T: dict, jobs: dict) -> None:
    """Run independent table writes as concurrent Spark jobs (one driver thread each)."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = {name: pool.submit(fn) for name, fn in jobs.items()}
    for name, fut in futures.items():
        out = fut.result()
        if name is not None:
            T[name] = out


CUSTOMERS_SCHEMA = M.flat_schema("customer_id bigint, full_name string, email string, city string, segment string, "
                                 "signup_date date, updated_at timestamp_ntz")
PRODUCTS_SCHEMA = M.flat_schema("product_id bigint, product_name string, category string, unit_price double")


@dataclass
class Inputs:
    """What a run loads: CSV paths (header required) or DataFrames in bronze shape.

    ``events`` is a DataFrame, the path of a table of decoded events, or None:
    then ``<root>/bronze/order_events``, where the ingestion stream appends.
    """

    customers: str | DataFrame
    products: str | DataFrame
    orders: str | DataFrame
    events: str | DataFrame | None = None


def _loaded(spark: SparkSession, source: str | DataFrame, schema, as_of: str) -> DataFrame:
    df = typed_csv(spark, source, schema) if isinstance(source, str) else source
    if isinstance(source, str) or "_ingested_at" not in df.columns:
        df = df.withColumn("_ingested_at", ts(as_of))
    return df


def driver_inputs(spark: SparkSession, sf_dir: str, snapshot: str) -> Inputs:
    """The bronze views of the driver's tables for one customer snapshot."""
    if snapshot not in SNAPSHOTS:
        raise ValueError(f"unknown snapshot {snapshot!r}, expected one of {SNAPSHOTS}")
    dt = DriverTables(spark, sf_dir)
    return Inputs(dt.customers_raw(snapshot), dt.products_raw(1 if snapshot == "day1" else 2), dt.orders_raw(), dt.order_events())


def run_medallion(spark: SparkSession, sf_dir: str, root: str, snapshot: str = "day1",
                  as_of: str | None = None, keep_unroutable: bool = False, run_id: str | None = None) -> RunResult:
    """``run_pipeline`` over the bronze views of the driver's tables."""
    return run_pipeline(spark, driver_inputs(spark, sf_dir, snapshot), root, snapshot, as_of, keep_unroutable, run_id)


def run_pipeline(spark: SparkSession, inputs: Inputs, root: str, snapshot: str = "day1",
                 as_of: str | None = None, keep_unroutable: bool = False, run_id: str | None = None,
                 calendar: tuple[date, date] | None = None) -> RunResult:
    """One full run for ``snapshot``; raises ``QualityGateError`` at the first failed gate and
    ``ExpectationsFailed`` if an expectation is not met (after its audit row is stored).

    ``as_of`` (UTC, default now) stamps audit rows and rejected events.
    ``keep_unroutable`` stores on-time events without an ``order_id`` in
    ``silver.order_events_unroutable`` instead of dropping them (the
    default keeps the reference behaviour).

    With ``run_id`` the run keeps a ledger of finished tables under ``root``. A run
    that broke off and is started again with the same id and inputs keeps its
    clock, reads the tables it had finished and goes on with the first that is missing.

    ``calendar`` gives the first and last day of ``gold.dim_date``; a fact outside fails
    its check. By default the calendar covers the orders, so that none is.
    """
    run = _begin(spark, root, snapshot, as_of, run_id)
    _bronze(run, inputs)
    _checks(*run.checks("bronze"))
    _silver(run, keep_unroutable)
    _checks(*run.checks("silver"))
    _gold(run, calendar)
    _checks(*run.checks("gold"))
    _expect(run)
    return run.result


@dataclass
class _Run:
    spark: SparkSession
    store: _Store
    run_ts: Column
    result: RunResult

    def checks(self, stage: str) -> tuple:
        return self.store, self.result.tables, stage, self.run_ts, self.result


def _begin(spark: SparkSession, root: str, snapshot: str, as_of: str | None, run_id: str | None = None) -> _Run:
    as_of = as_of or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    ledger = Ledger(spark, root, run_id) if run_id else None
    if ledger is not None:
        as_of = ledger.setting("as_of", as_of)
    r = RunResult(root, snapshot, as_of)
    return _Run(spark, _Store(spark, root, r.rows_written, ledger), ts(as_of), r)


def seed(spark: SparkSession, inputs: Inputs, root: str, snapshot: str = "day1", as_of: str | None = None) -> RunResult:
    """Load the bronze tables alone."""
    run = _begin(spark, root, snapshot, as_of)
    _bronze(run, inputs)
    return run.result


def check_stage(spark: SparkSession, root: str, stage: str, as_of: str | None = None) -> RunResult:
    """The checks of one stage over the stored tables, with audit rows and gate."""
    run = _begin(spark, root, "", as_of)
    run.result.tables.update(_stored(run.store))
    _checks(*run.checks(stage))
    return run.result


def check_expectations(spark: SparkSession, root: str, as_of: str | None = None) -> RunResult:
    """The expectation suites over the stored tables, with audit rows; raises ``ExpectationsFailed``."""
    run = _begin(spark, root, "", as_of)
    run.result.tables.update(_stored(run.store))
    _expect(run)
    return run.result


def _stored(s: _Store) -> dict[str, DataFrame]:
    """The layer tables as they are stored; a replaced table that was never written is left out."""
    found = {}
    loaded = s.path("bronze.order_events_loaded")
    for layer, names in M.Layers.NAMES.items():
        for name in (f"{layer}.{t}" for t in names):
            try:
                found[name] = s.read(name)
            except FileNotFoundError:
                if name == "bronze.order_events" and not store.has_data(s.spark, s.path(name)) and store.path_exists(s.spark, loaded):
                    found[name] = s.read("bronze.order_events_loaded", BRONZE_EVENTS_SCHEMA)
                elif name in GROWING:
                    found[name] = s.read_table(name, GROWING[name])
    return found


def _bronze(run: _Run, inputs: Inputs) -> None:
    spark, s, T, as_of, snapshot = run.spark, run.store, run.result.tables, run.result.as_of, run.result.snapshot

    def events_in() -> DataFrame:
        if isinstance(inputs.events, DataFrame):
            # beside the stream's table, which a run reads and never writes
            return s.replace("bronze.order_events_loaded", lambda: inputs.events.select(*BRONZE_EVENT_COLUMNS)
                             .withColumn("dt", F.to_date("event_time")), partition_by=["dt"])
        path = inputs.events or s.path("bronze.order_events")
        if store.has_data(spark, path):
            return spark.read.parquet(path).select(*BRONZE_EVENT_COLUMNS, F.to_date("event_time").alias("dt"))
        return M.empty(spark, BRONZE_EVENTS_SCHEMA)

    # bronze: customers are replaced per snapshot label, the rest is a full reload
    prev_cust = s.read("bronze.customers_raw", M.flat_schema(
        "customer_id bigint, full_name string, email string, city string, segment string, signup_date date, "
        "updated_at timestamp_ntz, snapshot string, _ingested_at timestamp_ntz"))
    _parallel(T, {
        "bronze.customers_raw": lambda: s.replace("bronze.customers_raw", lambda: snapshot_replace(
            prev_cust, _loaded(spark, inputs.customers, CUSTOMERS_SCHEMA, as_of), "snapshot", snapshot)),
        "bronze.products_raw": lambda: s.replace("bronze.products_raw", lambda: _loaded(spark, inputs.products, PRODUCTS_SCHEMA, as_of)),
        "bronze.orders_raw": lambda: s.replace("bronze.orders_raw", lambda: _loaded(spark, inputs.orders, M.RAW_ORDERS_SCHEMA, as_of)),
        "bronze.order_events": events_in,
    })


def _silver(run: _Run, keep_unroutable: bool) -> None:
    """MERGE into the previous versions."""
    spark, s, T, run_ts = run.spark, run.store, run.result.tables, run.run_ts

    def events() -> None:
        outputs = {"silver.order_events": EVENTS_SCHEMA, "silver.order_events_rejected": REJECTED_SCHEMA}
        if keep_unroutable:
            outputs["silver.order_events_unroutable"] = EVENTS_SCHEMA
        if not all(s.finished(name) for name in outputs):
            routed = M.route(T["bronze.order_events"].drop("dt"))
            routed = routed.over(store.materialize(routed.routed, "routed_events", partition_by=["route"]))
            # Event history grows by appends: an insert-only MERGE asks the table's key index
            # which events are new and appends them; the stored history is neither read nor
            # rewritten (same as the streaming sink).
            rejected = routed.rejected.select(*M.EVENT_COLUMNS, "reject_reason", F.lit(run_ts).alias("rejected_at"))
            rows = {"silver.order_events": routed.accepted.select(*M.EVENT_COLUMNS), "silver.order_events_rejected": rejected,
                    "silver.order_events_unroutable": routed.unroutable.select(*M.EVENT_COLUMNS)}
            for name in outputs:
                if not s.finished(name):
                    merge_into_partitions(s.path(name), rows[name].withColumn("dt", F.to_date("event_time")), "event_id", ["dt"],
                                          [], [NotMatched()], check_unique_source=False,
                                          index=KeyIndex.beside(spark, s.path(name), "event_id", ["dt"]))
                    s.finish(name)
        for name, schema in outputs.items():
            T[name] = s.read_table(name, schema).select(*schema.fieldNames())

    _parallel(T, {
        "silver.customers": lambda: s.replace("silver.customers", lambda: merge_conditional(
            s.read("silver.customers", M.flat_schema(
                "customer_id bigint, full_name string, email string, city string, segment string, "
                "signup_date date, updated_at timestamp_ntz")),
            M.silver_customers(T["bronze.customers_raw"]), "customer_id", "updated_at")),
        "silver.products": lambda: s.replace("silver.products", lambda: merge_upsert(
            s.read("silver.products", M.flat_schema(
                "product_id bigint, product_name string, category string, unit_price double")),
            M.silver_products(T["bronze.products_raw"]), "product_id")),
        None: events,
    })
    T["silver.orders"] = s.replace("silver.orders", lambda: M.silver_orders(
        spark, M.batch_orders(T["bronze.orders_raw"]), T["silver.order_events"],
        previous=s.read("silver.orders", M.ORDERS_SCHEMA)))


def _gold(run: _Run, calendar: tuple[date, date] | None) -> None:
    spark, s, T = run.spark, run.store, run.result.tables
    _parallel(T, {
        "gold.dim_customer": lambda: s.replace("gold.dim_customer", lambda: scd2_apply(
            s.read("gold.dim_customer", M.DIM_CUSTOMER_SCHEMA), T["silver.customers"], "customer_id",
            M.SCD2_TRACKED, M.CUSTOMER_ATTRS, "customer_sk", stage=lambda df: store.materialize(df, "scd2_changes"))),
        "gold.dim_product": lambda: s.replace("gold.dim_product", lambda: scd1(
            s.read("gold.dim_product", M.DIM_PRODUCT_SCHEMA), T["silver.products"], "product_id", sk="product_sk")),
        "gold.dim_date": lambda: s.replace("gold.dim_date", lambda: dim_date(spark, *calendar) if calendar
                                          else dim_date_covering(T["silver.orders"], "order_ts")),
    })
    # month partitions: a multi-year fact in day folders means thousands of
    # directories to list per read; a month keeps pruning useful and folders few
    T["gold.fact_orders"] = s.replace("gold.fact_orders", lambda: fact_orders(
        T["silver.orders"], T["gold.dim_customer"], T["gold.dim_product"])
        .withColumn("month", F.trunc(F.col("order_ts").cast("date"), "month")),
        partition_by=["month"]).drop("month")
    T["gold.daily_sales"] = s.replace("gold.daily_sales", lambda: daily_sales(T["gold.fact_orders"], T["gold.dim_product"]))


def _expect(run: _Run) -> None:
    """Expectation suites (declarative), appended to the audit trail."""
    s, T, run_ts = run.store, run.result.tables, run.run_ts
    parts = [ex.run_suite(T[t], t, es, run_ts) for t, es in M.suites().items()]
    ge = parts[0]
    for p in parts[1:]:
        ge = ge.unionByName(p)
    results = store.materialize(ge.select(*GE_RESULTS_SCHEMA.fieldNames()), "ge_results")
    T["audit.ge_results"] = _audited(s, "audit.ge_results", results, F.col("run_ts") == run_ts)
    T["audit.dq_results"] = s.read_table("audit.dq_results")
    ex.assert_suite(results)
