"""Bronze-shaped views over the driver's TPC-H-like tables.

The medallion operators are table-agnostic; these adapters give them
order-shaped input derived deterministically from ``customer``, ``nation``,
``part``, ``orders``, ``lineitem`` and ``events``, with dirty values planted
by rule (NULL customer, unknown product, negative quantity, malformed
payloads). Every adapter reads its whole source tables. The DuckDB oracle
builds the same views as CTEs (``strata.plans.oracle``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values used to derive the bronze views (they must equal the oracle's).
DAY1_UPDATED = "1996-01-01 00:00:00"     # updated_at of every customer in snapshot day1
DAY2_UPDATED = "1998-01-01 00:00:00"     # updated_at of customers that moved in day2
DAY1_LOADED = "1996-01-02 00:00:00"      # _ingested_at of snapshot day1
DAY2_LOADED = "1998-01-02 00:00:00"      # _ingested_at of snapshot day2
MOVED_EVERY = 13                         # c_custkey % 13 = 0 moves to city 'MOVED' in day2
SIGNUP_BASE = "1994-01-01"               # signup_date = base + c_custkey % 365 days
PRODUCTS_LOAD1 = "1995-01-01 00:00:00"   # _ingested_at of the first product dump
PRODUCTS_LOAD2 = "1998-01-01 00:00:00"   # _ingested_at of the second product dump
REPRICE_MIN_SIZE = 40                    # parts with p_size > 40 cost 10.0 more in dump 2
NULL_CUSTOMER_EVERY = 37                 # l_suppkey % 37 = 0 → customer_id NULL
UNKNOWN_PRODUCT_EVERY = 103              # l_partkey % 103 = 0 → product_id −99
NEGATIVE_QTY_EVERY = 101                 # l_partkey % 101 = 0 → quantity negated
LATE_HOURS_MOD = 60                      # event arrives (event_id % 60) hours after event_time
BAD_JSON_EVERY = 97                      # payload truncated
BAD_QTY_EVERY = 89                       # quantity sent as the string "x"
NO_ID_EVERY = 83                         # payload without event_id
BAD_TOKEN_QTY_EVERY = 53                 # csv: quantity 'n/a'
BAD_TOKEN_TS_EVERY = 59                  # csv: order_ts 'not a date'
BAD_TOKEN_PRICE_EVERY = 61               # csv: unit_price 'abc'
ZONED_TS_EVERY = 7                       # csv and payloads: time written five hours on, with +05:00
UTC_TS_EVERY = 11                        # payloads: time written with Z
# event_type → order status
EVENT_STATUS = {"signup": "created", "click": "paid", "view": "shipped", "purchase": "completed", "error": "cancelled"}
RUN_AS_OF = "2026-01-01 00:00:00"        # fixed run clock (_ingested_at / run_ts / rejected_at)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


#: Column of the order's number in ``order_lines``.
ORDER_KEY = "_order_key"


def order_key_of(order_id: str) -> Column:
    """The order's number that an ``order_id`` of a batch order begins with; NULL where it cannot be one."""
    return F.when(F.col(order_id).rlike("^-?[0-9]+-"), F.regexp_extract(order_id, "^(-?[0-9]+)-", 1).try_cast("long"))


def ts(value: str):
    return F.lit(value).cast("timestamp_ntz")


def _status():
    return F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in EVENT_STATUS.items()], F.col("event_type"))


#: Rows of a reference table that is broadcast at most.
SMALL_ROWS = 10_000


@dataclass
class DriverTables:
    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")

    # -- customers -----------------------------------------------------------------------
    def customers_raw(self, snapshot: str) -> DataFrame:
        """One full customer dump (``day1`` or ``day2``) with lineage columns."""
        if snapshot not in ("day1", "day2"):
            raise ValueError(f"unknown snapshot {snapshot!r}, expected day1 or day2")
        c = self.table("customer")
        # nation is fixed reference data (25 rows); its size is checked before it
        # is broadcast instead of shuffling the customers
        n = self.table("nation").select("n_nationkey", "n_name")
        n = F.broadcast(n) if n.count() <= SMALL_ROWS else n
        j = c.join(n, c["c_nationkey"] == n["n_nationkey"], "left")
        moved = (F.col("c_custkey") % MOVED_EVERY == 0) if snapshot == "day2" else F.lit(False)
        return j.select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("full_name"),
            F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
            F.when(moved, F.lit("MOVED")).otherwise(F.col("n_name")).alias("city"),
            F.col("c_mktsegment").alias("segment"),
            F.date_add(F.lit(SIGNUP_BASE).cast("date"), (F.col("c_custkey") % 365).cast("int")).alias("signup_date"),
            F.when(moved, ts(DAY2_UPDATED)).otherwise(ts(DAY1_UPDATED)).alias("updated_at"),
            F.lit(snapshot).alias("snapshot"),
            ts(DAY1_LOADED if snapshot == "day1" else DAY2_LOADED).alias("_ingested_at"))

    def customers_bronze(self) -> DataFrame:
        return self.customers_raw("day1").unionByName(self.customers_raw("day2"))

    # -- products ------------------------------------------------------------------------
    def products_raw(self, load: int) -> DataFrame:
        """Full product dump ``load`` (1 or 2); dump 2 reprices large parts."""
        p = self.table("part")
        price = F.col("p_retailprice")
        if load == 2:
            price = F.when(F.col("p_size") > REPRICE_MIN_SIZE, price + F.lit(10.0)).otherwise(price)
        return p.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
                        F.col("p_type").alias("category"), price.alias("unit_price"),
                        ts(PRODUCTS_LOAD1 if load == 1 else PRODUCTS_LOAD2).alias("_ingested_at"))

    def products_bronze(self) -> DataFrame:
        return self.products_raw(1).unionByName(self.products_raw(2))

    # -- batch orders --------------------------------------------------------------------
    def orders_raw(self) -> DataFrame:
        """Order lines as batch orders; ``order_id`` repeats across lines."""
        return self.order_lines().drop(ORDER_KEY)

    def order_lines(self) -> DataFrame:
        """``orders_raw`` with the order's number, which ``order_id`` begins with.

        The join leaves the rows partitioned by that number, so what groups by it and
        ``order_id`` shuffles nothing (``keyed.latest_by(within=ORDER_KEY)``).
        """
        li = self.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                           "l_quantity", "l_extendedprice", "l_returnflag",
                                           "l_linestatus", "l_shipdate")
        o = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
        qty = F.col("l_quantity").cast("int")
        return j.select(
            F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("order_id"),
            F.when(F.col("l_suppkey") % NULL_CUSTOMER_EVERY == 0, F.lit(None)).otherwise(F.col("o_custkey")).alias("customer_id"),
            F.when(F.col("l_partkey") % UNKNOWN_PRODUCT_EVERY == 0, F.lit(-99).cast("long")).otherwise(F.col("l_partkey")).alias("product_id"),
            F.when(F.col("l_partkey") % NEGATIVE_QTY_EVERY == 0, -qty).otherwise(qty).alias("quantity"),
            F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("unit_price"),
            F.col("l_extendedprice").alias("total_amount"),
            F.when(F.col("l_returnflag") == "R", "cancelled").when(F.col("l_linestatus") == "O", "shipped")
             .otherwise("completed").alias("status"),
            F.col("o_orderdate").alias("order_ts"),
            F.col("l_shipdate").alias("_ingested_at"),
            F.col("l_orderkey").alias(ORDER_KEY))

    def orders_raw_strings(self) -> DataFrame:
        """``orders_raw`` as an all-string CSV would deliver it, with bad tokens."""
        r = self.orders_raw()
        k = F.split(F.col("order_id"), "-").getItem(0).cast("long")
        s = lambda c: F.col(c).cast("string")
        return r.select(
            "order_id", s("customer_id").alias("customer_id"), s("product_id").alias("product_id"),
            F.when(k % BAD_TOKEN_QTY_EVERY == 0, F.lit("n/a")).otherwise(s("quantity")).alias("quantity"),
            F.when(k % BAD_TOKEN_PRICE_EVERY == 0, F.lit("abc")).otherwise(s("unit_price")).alias("unit_price"),
            s("total_amount").alias("total_amount"), "status",
            F.when(k % BAD_TOKEN_TS_EVERY == 0, F.lit("not a date"))
             .when(k % ZONED_TS_EVERY == 0, F.concat((F.col("order_ts") + F.expr("INTERVAL 5 HOURS")).cast("string"), F.lit("+05:00")))
             .otherwise(s("order_ts")).alias("order_ts"))

    # -- stream events -------------------------------------------------------------------
    def order_events(self) -> DataFrame:
        """Bronze order events: per-user lifecycles, arrival 0–59 h after the event."""
        e = self.table("events")
        late = F.make_dt_interval(F.lit(0), (F.col("event_id") % LATE_HOURS_MOD).cast("int"),
                                  F.lit(0), F.lit(0))
        qty = F.get_json_object("props", "$.k").try_cast("int") % 5 + 1
        return e.select(
            F.col("event_id").cast("string").alias("event_id"),
            F.concat(F.lit("U-"), F.col("user_id").cast("string")).alias("order_id"),
            F.col("user_id").alias("customer_id"),
            F.col("user_id").alias("product_id"),
            qty.cast("int").alias("quantity"),
            F.col("value").alias("unit_price"),
            _status().alias("status"),
            F.col("ts").alias("event_time"),
            F.col("ts").alias("produced_at"),
            (F.col("ts") + late).alias("_ingested_at"),
            (F.col("event_id") % 3).cast("int").alias("kafka_partition"),
            F.col("event_id").alias("kafka_offset"))

    def payloads(self) -> DataFrame:
        """Message-bus records ``(value, partition, offset)`` carrying JSON events."""
        e = self.table("events")
        fmt = "yyyy-MM-dd HH:mm:ss"
        t = (F.when(F.col("event_id") % ZONED_TS_EVERY == 0,
                    F.concat(F.date_format(F.col("ts") + F.expr("INTERVAL 5 HOURS"), fmt), F.lit("+05:00")))
              .when(F.col("event_id") % UTC_TS_EVERY == 0, F.concat(F.date_format("ts", fmt), F.lit("Z")))
              .otherwise(F.date_format("ts", fmt)))
        eid = F.col("event_id").cast("string")
        uid = F.col("user_id").cast("string")
        qty = (F.get_json_object("props", "$.k").try_cast("int") % 5 + 1).cast("string")
        id_part = F.when(F.col("event_id") % NO_ID_EVERY == 0, F.lit("")).otherwise(
            F.concat(F.lit('"event_id": "'), eid, F.lit('", ')))
        qty_part = F.when(F.col("event_id") % BAD_QTY_EVERY == 0, F.lit('"x"')).otherwise(qty)
        body = F.concat(
            F.lit("{"), id_part,
            F.lit('"order_id": "U-'), uid, F.lit('", "customer_id": '), uid,
            F.lit(', "product_id": '), uid, F.lit(', "quantity": '), qty_part,
            F.lit(', "unit_price": '), F.col("value").cast("string"),
            F.lit(', "status": "'), _status(),
            F.lit('", "event_time": "'), t, F.lit('", "produced_at": "'), t, F.lit('"}'))
        broken = F.concat(F.lit('{"event_id": "'), eid, F.lit('", "quantity": '))
        value = F.when(F.col("event_id") % BAD_JSON_EVERY == 0, broken).otherwise(body)
        return e.select(value.alias("value"), (F.col("event_id") % 3).cast("int").alias("partition"),
                        F.col("event_id").alias("offset"))
