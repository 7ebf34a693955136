"""The order medallion: bronze → silver → gold as one composition of operators.

Everything here is lazy DataFrame plumbing over the operators; the layer
builders return dictionaries of DataFrames. ``strata.plans.runner`` writes
them stage by stage with quality gates in between.
"""

from __future__ import annotations

import threading
from collections import Counter
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions.columns import flat_schema, not_null
from strata.operators import expectations as ex
from strata.operators import quality as dq
from strata.operators.keyed import latest_by
from strata.operators.late import ACCEPTED, ROUTE, Routed, route_events, stream_orders
from strata.operators.merge import Matched, NotMatched, merge
from strata.operators.observed import Watch
from strata.operators.scd import scd1, scd2_apply
from strata.operators.star import daily_sales, fact_orders
from strata.sinks import store
from strata.sources.calendar import dim_date_covering
from strata.sources.driver_tables import ORDER_KEY, RUN_AS_OF, DriverTables, order_key_of, ts

CUSTOMER_COLUMNS = ["customer_id", "full_name", "email", "city", "segment", "signup_date", "updated_at"]
CUSTOMER_ATTRS = ["full_name", "email", "city", "segment", "signup_date"]
# Attributes whose change opens a new customer version.
SCD2_TRACKED = ["full_name", "email", "city", "segment"]
PRODUCT_COLUMNS = ["product_id", "product_name", "category", "unit_price"]
ORDER_COLUMNS = ["order_id", "customer_id", "product_id", "quantity", "unit_price", "total_amount",
                 "status", "order_ts", "source", "updated_at"]
EVENT_COLUMNS = ["event_id", "order_id", "customer_id", "product_id", "quantity", "unit_price", "status",
                 "event_time", "produced_at", "_ingested_at", "lateness_hours"]
REJECTED_COLUMNS = EVENT_COLUMNS + ["reject_reason", "rejected_at"]

ORDERS_SCHEMA = flat_schema(
    "order_id string, customer_id bigint, product_id bigint, quantity int, unit_price double, "
    "total_amount double, status string, order_ts timestamp_ntz, source string, updated_at timestamp_ntz")
DIM_CUSTOMER_SCHEMA = flat_schema(
    "customer_sk bigint, customer_id bigint, full_name string, email string, city string, segment string, "
    "signup_date date, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean")
DIM_PRODUCT_SCHEMA = flat_schema(
    "product_sk bigint, product_id bigint, product_name string, category string, unit_price double")
RAW_ORDERS_SCHEMA = flat_schema(
    "order_id string, customer_id bigint, product_id bigint, quantity int, unit_price double, "
    "total_amount double, status string, order_ts timestamp_ntz")

LATE_LIMIT_HOURS = 48


def run_ts():
    return ts(RUN_AS_OF)


# -- silver builders ------------------------------------------------------------------------

def silver_customers(customers_raw: DataFrame) -> DataFrame:
    """Latest state per customer: newest ``updated_at``, then newest load."""
    live = customers_raw.filter(F.col("customer_id").isNotNull())
    return latest_by(live, "customer_id", ["updated_at DESC", "_ingested_at DESC"]).select(*CUSTOMER_COLUMNS)


def silver_products(products_raw: DataFrame) -> DataFrame:
    """Latest valid product row per id (negative prices never reach silver)."""
    live = products_raw.filter(F.col("product_id").isNotNull() & (F.col("unit_price") >= 0))
    return latest_by(live, "product_id", ["_ingested_at DESC"]).select(*PRODUCT_COLUMNS)


def clean_orders(orders_raw: DataFrame) -> DataFrame:
    """Keys and time present, positive quantity, non-negative amount.

    Runs before dedup, so a dirty newest row never hides a clean older one.
    A NULL measure fails the predicate and drops the row.
    """
    return orders_raw.filter(not_null(["order_id", "customer_id", "order_ts"])
                             & (F.col("quantity") > 0) & (F.col("total_amount") >= 0))


def batch_orders(orders_raw: DataFrame, tiebreak=None) -> DataFrame:
    """Clean, deduplicated batch orders in silver shape (``source='batch'``).

    Among rows of one load the first under ``tiebreak`` stays (default: the
    order's own columns, in schema order). Rows with the order's number
    (``order_lines``) are deduplicated where their join left them, and keep it.
    """
    tiebreak = tiebreak or [c for c in RAW_ORDERS_SCHEMA.fieldNames() if c != "order_id"]
    within = [ORDER_KEY] if ORDER_KEY in orders_raw.columns else []
    latest = latest_by(clean_orders(orders_raw), "order_id", ["_ingested_at DESC"], tiebreak=tiebreak, within=within[0] if within else None)
    return latest.select(*RAW_ORDERS_SCHEMA.fieldNames(), F.lit("batch").alias("source"),
                         F.col("_ingested_at").alias("updated_at"), *within)


def route(order_events: DataFrame) -> Routed:
    return route_events(order_events, limit_hours=LATE_LIMIT_HOURS, key="event_id",
                        required=("order_id",), tiebreak=["kafka_partition", "kafka_offset DESC"],
                        reason=f"arrived more than {LATE_LIMIT_HOURS}h after event_time",
                        rejected_at=run_ts())


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """A typed empty table the optimizer can see through (``store.empty_table``)."""
    return store.empty_table(spark, schema)


def silver_orders(spark: SparkSession, batch: DataFrame, accepted: DataFrame,
                  previous: DataFrame | None = None) -> DataFrame:
    """Batch orders (never overwriting stream-owned ones), then the stream upsert — as ONE MERGE.

    Applying the guarded batch MERGE and then the unconditional stream
    upsert equals a single MERGE whose source is every stream order plus the
    batch orders the stream does not carry, with ``WHEN MATCHED AND
    (s.source = 'stream' OR t.source = 'batch') THEN UPDATE``. The target,
    the largest input, is joined (and shuffled) once instead of twice. Both
    inputs are unique per order_id by construction (``latest_by``, a
    ``groupBy``) and disjoint after the anti join, so the duplicate-source
    check is skipped. Batch orders with the order's number meet the stream's by that
    number, which both derive from the id: they stay where their join left them.
    """
    target = previous if previous is not None else empty(spark, ORDERS_SCHEMA)
    stream = stream_orders(accepted).select(*ORDER_COLUMNS)
    if ORDER_KEY in batch.columns:
        ids = accepted.select(order_key_of("order_id").alias("__s_key"), F.col("order_id").alias("__s_id")).filter(F.col("__s_key").isNotNull())
        ids = ids.groupBy("__s_key").agg(F.collect_set("__s_id").alias("__s_ids"))
        known = F.coalesce(F.array_contains("__s_ids", F.col("order_id")), F.lit(False))
        batch_only = batch.join(ids, F.col(ORDER_KEY) == F.col("__s_key"), "left").filter(~known).select(*ORDER_COLUMNS)
    else:
        batch_only = batch.select(*ORDER_COLUMNS).join(stream.select("order_id"), "order_id", "left_anti")
    wins = lambda t, s: (s["source"] == F.lit("stream")) | (t["source"] == F.lit("batch"))
    return merge(target, batch_only.unionByName(stream), "order_id", [Matched(cond=wins)], [NotMatched()],
                 check_unique_source=False)


# -- gold builders --------------------------------------------------------------------------

def dim_customer(spark: SparkSession, states: list[DataFrame],
                 previous: DataFrame | None = None, stage=None) -> DataFrame:
    """Apply SCD2 runs in order, one per silver customer state.

    ``stage`` (e.g. ``store.materialize``) pins each run's change set, which
    the close and open steps both read.
    """
    dim = previous if previous is not None else empty(spark, DIM_CUSTOMER_SCHEMA)
    for state in states:
        dim = scd2_apply(dim, state, "customer_id", SCD2_TRACKED, CUSTOMER_ATTRS, "customer_sk", stage=stage)
    return dim


def dim_product(spark: SparkSession, states: list[DataFrame],
                previous: DataFrame | None = None) -> DataFrame:
    """Type 1 runs in order; ``product_sk = product_id``."""
    dim = previous if previous is not None else empty(spark, DIM_PRODUCT_SCHEMA)
    for state in states:
        dim = scd1(dim, state, "product_id", sk="product_sk")
    return dim


class Layers:
    """The 14 layer tables over the driver's data, built on first use.

    Two customer snapshots (day1, day2) and two product dumps are loaded, so
    the dimensions go through an insert run and an update run. With
    ``materialize`` every silver and gold table (and each SCD2 run) is
    written once to the shared checkpoint folder and read back, as the layer
    tables of a real run are: later stages start from files (short lineage,
    column pruning, nothing recomputed after a lost executor) instead of
    re-planning the whole chain. Tables are built lazily, so a query that
    reads one table builds only that table and what it depends on.
    """

    NAMES = {
        "bronze": ["customers_raw", "products_raw", "orders_raw", "order_events"],
        "silver": ["customers", "products", "orders", "order_events", "order_events_rejected"],
        "gold": ["dim_customer", "dim_product", "dim_date", "fact_orders", "daily_sales"],
    }

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True, observe: bool = False):
        self.spark = spark
        self.observe = observe        # count row checks and expectations in the writes; raw tables are then written too
        self.watches: dict[str, Watch] = {}
        self.dt = DriverTables(spark, sf_dir)
        self.materialize = materialize
        self._cache: dict[str, DataFrame] = {}
        self._shared: set[str] = set()       # tables that several readers asked for
        self._routed: Routed | None = None
        self._guard = threading.Lock()
        self._locks: dict[str, threading.Lock] = {}

    def _lock(self, name: str) -> threading.Lock:
        with self._guard:
            return self._locks.setdefault(name, threading.Lock())

    def prefetch(self, names, workers: int = 4) -> None:
        """Build the named tables (and what they depend on) concurrently.

        Independent tables (customers, products, events, the two dimension
        chains) are separate Spark jobs; submitting them from several threads
        lets the scheduler run them side by side instead of leaving executors
        idle between small jobs. Each table is built once: a per-table lock
        makes a second requester wait for the first build.
        """
        names = [n for n in dict.fromkeys(names) if n in self]
        self._shared.update(names)
        if not self.materialize or len(names) < 2:
            for n in names:
                self[n]
            return
        with ThreadPoolExecutor(max_workers=min(workers, len(names))) as pool:
            list(pool.map(self.__getitem__, names))

    def stage_bronze(self) -> None:
        """Write the joined raw orders once, for callers that read them and build silver from them."""
        name = "bronze.orders_raw"
        with self._lock(name):
            if name not in self._cache:
                self._cache[name] = self._keep(self._bronze_orders_raw(), "bronze_orders_raw")

    def order_lines(self) -> DataFrame:
        """The raw orders with the order's number, unless they are staged: then without."""
        return self._cache.get("bronze.orders_raw", self.dt.order_lines())

    def _keep(self, df: DataFrame, name: str, partition_by=None) -> DataFrame:
        return store.materialize(df, name, partition_by, self._watch(name)) if self.materialize else df

    def _raw(self, df: DataFrame, name: str) -> DataFrame:
        return self._keep(df, name) if self.observe else df

    def _watch(self, name: str) -> Watch | None:
        """The row checks and expectations of the table that is written as ``name``."""
        if not self.observe:
            return None
        table, rows = name.replace("_", ".", 1), None
        if name == "silver_routed_events":      # one write holds both routes
            table, rows = "silver.order_events", F.col(ROUTE) == ACCEPTED
        counts = dq.row_counts([c for cs in checks().values() for c in cs if c.table == table], rows)
        counts |= ex.row_counts(suites().get(table, []), rows)
        self.watches[table] = Watch(counts)
        return self.watches[table]

    def _stage(self, name: str):
        return (lambda df: self._keep(df, name)) if self.materialize else None

    def tables_for_checks(self, stages=("bronze", "silver", "gold"), kinds=None) -> dict[str, int]:
        """The tables that the checks read, and how often (the row checks of a table share one scan)."""
        scans = []
        for st in stages:
            for c in checks()[st]:
                if kinds is None or c.kind in kinds:
                    scans.append((c.table, "rows" if c.kind in dq.ROW_KINDS else c.name))
                    if c.kind == "ref_integrity":
                        scans.append((c.params["parent"], c.name))
        return Counter(table for table, _ in dict.fromkeys(scans))

    def unstaged(self, name: str) -> DataFrame:
        """The plan of a fact or mart that one reader needs: it is not written and read again first.

        The staged table, if one was asked for (``prefetch``).
        """
        if name in self._cache or name in self._shared:
            return self[name]
        return getattr(self, "_plan_" + name.split(".")[1])()

    UNSTAGED = ("gold.fact_orders", "gold.daily_sales")

    def for_reads(self, reads: Mapping[str, int]) -> dict[str, DataFrame]:
        """The tables of ``reads``. A fact or mart that is read once is its plan, so that only the columns its reader needs are computed."""
        once = [n for n in reads if n in self.UNSTAGED and reads[n] == 1 and not self.observe]
        if "gold.daily_sales" in reads and "gold.fact_orders" in once:
            once.remove("gold.fact_orders")     # the mart reads it too
        self.prefetch([n for n in reads if n not in once])
        return {n: self.unstaged(n) if n in once else self[n] for n in reads}

    def __getitem__(self, name: str) -> DataFrame:
        layer, _, table = name.partition(".")
        if table not in self.NAMES.get(layer, []):
            raise KeyError(name)
        with self._lock(name):
            if name not in self._cache:
                self._cache[name] = getattr(self, f"_{layer}_{table}")()
        return self._cache[name]

    def __contains__(self, name: str) -> bool:
        layer, _, table = name.partition(".")
        return table in self.NAMES.get(layer, [])

    def names(self) -> list[str]:
        return [f"{layer}.{t}" for layer, ts_ in self.NAMES.items() for t in ts_]

    def all(self) -> dict[str, DataFrame]:
        return {n: self[n] for n in self.names()}

    # bronze: lazy views over the driver tables
    def _bronze_customers_raw(self):
        return self._raw(self.dt.customers_bronze(), "bronze_customers_raw")

    def _bronze_products_raw(self):
        return self._raw(self.dt.products_bronze(), "bronze_products_raw")

    def _bronze_orders_raw(self):
        return self._raw(self.dt.orders_raw(), "bronze_orders_raw")

    def _bronze_order_events(self):
        return self._raw(self.dt.order_events(), "bronze_order_events")

    # silver
    def routed(self) -> Routed:
        """One pass over the events and one write partitioned by route."""
        with self._lock("routed"):
            if self._routed is None:
                r = route(self["bronze.order_events"])
                self._routed = r.over(self._keep(r.routed, "silver_routed_events", partition_by=[ROUTE]))
        return self._routed

    def _silver_customers(self):
        return self._keep(silver_customers(self["bronze.customers_raw"]), "silver_customers")

    def _silver_products(self):
        return self._keep(silver_products(self["bronze.products_raw"]), "silver_products")

    def _silver_order_events(self):
        return self.routed().accepted.select(*EVENT_COLUMNS)

    def _silver_order_events_rejected(self):
        return self.routed().rejected.select(*REJECTED_COLUMNS)

    def _silver_orders(self):
        # not from the staged raw orders: read from files they would have to be shuffled by order_id
        batch = batch_orders(self["bronze.orders_raw"] if self.observe else self.dt.order_lines())
        return self._keep(silver_orders(self.spark, batch, self["silver.order_events"]), "silver_orders")

    # gold
    def _dim_customer_run(self, i: int, previous: DataFrame, state: DataFrame) -> DataFrame:
        return self._keep(dim_customer(self.spark, [state], previous=previous,
                                       stage=self._stage(f"scd2_changes_run{i}")), f"gold_dim_customer_run{i}")

    def dim_customer_day1(self) -> DataFrame:
        """The customer dimension after the first (day1) SCD2 run."""
        with self._lock("gold.dim_customer.run1"):
            if "gold.dim_customer.run1" not in self._cache:
                self._cache["gold.dim_customer.run1"] = self._dim_customer_run(
                    1, empty(self.spark, DIM_CUSTOMER_SCHEMA), silver_customers(self.dt.customers_raw("day1")))
        return self._cache["gold.dim_customer.run1"]

    def _gold_dim_customer(self):
        run1 = self.dim_customer_day1()
        return self._dim_customer_run(2, run1, self["silver.customers"])

    def _gold_dim_product(self):
        states = [silver_products(self.dt.products_raw(1)), self["silver.products"]]
        return self._keep(dim_product(self.spark, states), "gold_dim_product")

    def _gold_dim_date(self):
        return self._keep(dim_date_covering(self["silver.orders"], "order_ts"), "gold_dim_date")

    def _plan_fact_orders(self):
        self.prefetch(["silver.orders", "gold.dim_customer", "gold.dim_product"])
        return fact_orders(self["silver.orders"], self["gold.dim_customer"], self["gold.dim_product"])

    def _plan_daily_sales(self):
        return daily_sales(self.unstaged("gold.fact_orders"), self["gold.dim_product"])

    def _gold_fact_orders(self):
        return self._keep(self._plan_fact_orders(), "gold_fact_orders")

    def _gold_daily_sales(self):
        fact = self["gold.fact_orders"] if self.observe else self.unstaged("gold.fact_orders")
        return self._keep(daily_sales(fact, self["gold.dim_product"]), "gold_daily_sales")


def build_layers(spark: SparkSession, sf_dir: str, materialize: bool = True, observe: bool = False) -> Layers:
    return Layers(spark, sf_dir, materialize, observe)


# -- quality definitions --------------------------------------------------------------------
# The 21 native checks (stage, name, severity, rule) of the order medallion.

def checks() -> dict[str, list[dq.Check]]:
    E, W = dq.ERROR, dq.WARN
    return {
        "bronze": [
            dq.not_empty("orders_raw_not_empty", "bronze.orders_raw", E),
            dq.not_empty("customers_raw_not_empty", "bronze.customers_raw", E),
            dq.not_empty("products_raw_not_empty", "bronze.products_raw", E),
            dq.null_keys("orders_raw_null_keys", "bronze.orders_raw", ["order_id", "customer_id"], W),
            dq.duplicates("orders_raw_duplicate_ids", "bronze.orders_raw", "order_id", W, within=ORDER_KEY),
            dq.predicate("orders_raw_negative_values", "bronze.orders_raw",
                         "quantity <= 0 OR total_amount < 0", W),
            dq.null_keys("order_events_null_event_id", "bronze.order_events", ["event_id"], W),
        ],
        "silver": [
            dq.not_empty("orders_not_empty", "silver.orders", E),
            dq.duplicates("orders_unique_order_id", "silver.orders", "order_id", E),
            dq.null_keys("orders_no_null_keys", "silver.orders", ["order_id", "customer_id"], E),
            dq.predicate("orders_positive_quantity", "silver.orders", "quantity <= 0", E),
            dq.predicate("orders_non_negative_amount", "silver.orders", "total_amount < 0", E),
            dq.ref_integrity("orders_customer_exists", "silver.orders", "customer_id",
                             "silver.customers", severity=E),
            dq.duplicates("order_events_unique_event_id", "silver.order_events", "event_id", E),
            dq.predicate("order_events_within_48h", "silver.order_events", "lateness_hours > 48", E),
        ],
        "gold": [
            dq.not_empty("fact_orders_not_empty", "gold.fact_orders", E),
            dq.duplicates("fact_orders_unique_order_id", "gold.fact_orders", "order_id", E),
            dq.single_current("dim_customer_single_current_version", "gold.dim_customer", "customer_id",
                              severity=E),
            dq.ref_integrity("fact_orders_valid_customer_sk", "gold.fact_orders", "customer_sk",
                             "gold.dim_customer", severity=E),
            dq.ref_integrity("fact_orders_valid_date_key", "gold.fact_orders", "date_key",
                             "gold.dim_date", severity=E),
            dq.predicate("daily_sales_non_negative_revenue", "gold.daily_sales", "revenue < 0", E),
        ],
    }


# The 15 expectations of the declarative suites.
ORDER_STATUSES = ["created", "paid", "shipped", "completed", "cancelled"]


def suites() -> dict[str, list[ex.Expectation]]:
    return {
        "silver.orders": [
            ex.values_not_null("order_id"),
            ex.values_unique("order_id"),
            ex.values_not_null("customer_id"),
            ex.values_between("quantity", min_value=1, max_value=1000),
            ex.values_between("total_amount", min_value=0),
            ex.values_in_set("status", ORDER_STATUSES),
            ex.row_count_between(min_value=1),
        ],
        "silver.order_events": [
            ex.values_not_null("event_id"),
            ex.values_unique("event_id"),
            ex.values_between("lateness_hours", max_value=48),
        ],
        "gold.fact_orders": [
            ex.values_not_null("order_id"),
            ex.values_unique("order_id"),
            ex.values_not_null("customer_sk"),
            ex.values_between("total_amount", min_value=0),
            ex.row_count_between(min_value=1),
        ],
    }


def run_stage_checks(tables, stages=("bronze", "silver", "gold"),
                     kinds: set[str] | None = None) -> DataFrame:
    """Audit rows for the chosen stages (and check kinds), one DataFrame."""
    if isinstance(tables, Layers):
        layers, tables = tables, tables.for_reads(tables.tables_for_checks(stages, kinds))
        if "bronze.orders_raw" in tables:
            tables["bronze.orders_raw"] = layers.order_lines()
    out = None
    for stage in stages:
        cs = [c for c in checks()[stage] if kinds is None or c.kind in kinds]
        if not cs:
            continue
        r = dq.run_checks(tables, cs, stage, run_ts())
        out = r if out is None else out.unionByName(r)
    return out


def observed_checks(layers: Layers) -> DataFrame:
    """Audit rows of the checks on single rows, counted by the writes of ``layers`` (built with ``observe``)."""
    per_stage = {stage: [c for c in cs if c.kind in dq.ROW_KINDS] for stage, cs in checks().items()}
    layers.prefetch([c.table for cs in per_stage.values() for c in cs])
    out = None
    for stage, cs in per_stage.items():
        counts = {n: v for t in dict.fromkeys(c.table for c in cs) for n, v in layers.watches[t].get().items()}
        r = dq.observed_results(layers.spark, counts, cs, stage, run_ts())
        out = r if out is None else out.unionByName(r)
    return out


def observed_suites(layers: Layers) -> DataFrame:
    """Audit rows of the expectations on single rows, counted by the writes of ``layers`` (built with ``observe``)."""
    layers.prefetch(list(suites()))
    out = None
    for table, es in suites().items():
        r = ex.observed_results(layers.spark, layers.watches[table].get(), table, es, run_ts())
        out = r if out is None else out.unionByName(r)
    return out


def run_suites(tables, kinds: set[str] | None = None) -> DataFrame:
    if isinstance(tables, Layers):
        chosen = {t: [e.kind for e in es if kinds is None or e.kind in kinds] for t, es in suites().items()}
        unique = "expect_column_values_to_be_unique"
        tables = tables.for_reads({t: ks.count(unique) + any(k != unique for k in ks) for t, ks in chosen.items() if ks})
    out = None
    for table, exps in suites().items():
        es = [e for e in exps if kinds is None or e.kind in kinds]
        if not es:
            continue
        r = ex.run_suite(tables[table], table, es, run_ts())
        out = r if out is None else out.unionByName(r)
    return out
