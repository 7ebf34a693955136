"""Star-schema builds: validity-interval key lookup, unknown member, fact, mart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from strata.functions.columns import OPEN_END, UNKNOWN_SK, date_key, null_key_salt, typed_null
from strata.operators.keys import RANGE, key_ranges
from strata.sinks.store import materialize


#: Intervals of one key that each of its facts is compared with at most; facts of keys with more are looked up by order.
BIN = 64
#: Versions of one key that one window takes at most; with more, it runs over ranges of them.
MANY = 100_000
#: Keys that are broadcast at most (one column); more are joined by a shuffle.
BROADCAST_BINS = 1_000_000


def lookup_intervals(dim: DataFrame, key: str, sk: str, valid_from: str = "effective_from",
                     valid_to: str = "effective_to", most: int | None = None) -> DataFrame:
    """Per key, intervals ``[lo, hi)`` that tile the whole time line, each with the sk to use.

    Covering versions keep their own ``[from, coalesce(to, OPEN_END))``
    (empty and NULL-start versions cover nothing; of overlapping versions the earliest
    start, then the lower sk, keeps the time it covers); every gap — before the
    first version, between versions, after the open end — maps to the key's
    earliest version (NULL ``valid_from`` first, then the lower sk). NULL
    ``lo``/``hi`` mean unbounded. ``null_ts`` flags the one interval a
    fact with a NULL time falls back to. One window over the versions of each
    key: a version emits the gap before it, what is left of it and, if it is the
    last, the gap behind. Versions without a key are left out.

    If a key has over ``MANY`` versions (``most``: as many as any has, counted by default), the window runs over ranges of (key, start) of about
    equal size instead, and each range of a key gets from those before what
    they hand on: the first sk and how far they reach.
    """
    time_type = dim.select(F.greatest(valid_from, valid_to).alias("t")).schema["t"].dataType
    v = dim.filter(F.col(key).isNotNull()).select(
        key, F.col(valid_from).cast(time_type).alias("__from"),
        F.coalesce(F.col(valid_to).cast(time_type), F.lit(OPEN_END).cast(time_type)).alias("__end"), F.col(sk).alias("__sk"))
    start, end = F.col("__from"), F.col("__end")
    covers = start.isNotNull() & (start < end)
    spread = (most if most is not None else most_versions(dim, key)) > MANY
    if spread:
        v = ranged = key_ranges(v, key, ["__from", "__sk"])
    w = Window.partitionBy(*([RANGE] if spread else []), key).orderBy(start.asc_nulls_first(), F.col("__sk").asc_nulls_first())
    v = v.select(*v.columns, F.first("__sk").over(w).alias("__first"), F.lead(F.lit(1)).over(w).isNull().alias("__last"),
                 F.max(F.when(covers, end)).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("__reach"))
    if spread:
        order = Window.partitionBy(key).orderBy(RANGE)
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        parts = _in_several(ranged, key, F.max(F.when(covers, end)).alias("__reach"), F.min(F.struct("__from", "__sk")).alias("__first"))
        parts = parts.select(F.col(RANGE).alias("__b_range"), F.col(key).alias("__b_key"), F.first("__first").over(order)["__sk"].alias("__b_first"),
                             F.max("__reach").over(before).alias("__b_reach"), F.lead(F.lit(1)).over(order).isNull().alias("__b_last"))
        v = v.join(F.broadcast(parts), (F.col(key) == F.col("__b_key")) & (F.col(RANGE) == F.col("__b_range")), "left")
        known = F.col("__b_key").isNotNull()
        v = v.select(key, "__from", "__end", "__sk", F.when(known, F.col("__b_first")).otherwise(F.col("__first")).alias("__first"),
                     (F.col("__last") & F.coalesce("__b_last", F.lit(True))).alias("__last"), F.greatest("__reach", "__b_reach").alias("__reach"))
    reach, first = F.col("__reach"), F.col("__first")  # how far the versions before reach
    kept = covers & (reach.isNull() | (reach < end))
    behind = F.greatest(reach, F.when(covers, end))

    def part(here, lo, hi, of, null_ts):
        return F.struct(F.coalesce(here, F.lit(False)).alias("here"), lo.alias("lo"), hi.alias("hi"), of.alias(sk), null_ts.alias("null_ts"))
    parts = F.array(part(kept & (reach.isNull() | (reach < start)), reach, start, first, reach.isNull()),
                    part(kept, F.greatest(start, reach), end, F.col("__sk"), F.lit(False)),
                    part(F.col("__last"), behind, typed_null(time_type), first, behind.isNull()))
    return v.select(key, F.explode(F.filter(parts, lambda x: x["here"])).alias("p")).select(key, "p.lo", "p.hi", f"p.{sk}", "p.null_ts")


def most_versions(dim: DataFrame, key: str) -> int:
    """The most rows that one key has."""
    return dim.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


def _in_several(ranged: DataFrame, key: str, *aggs: Column) -> DataFrame:
    """``aggs`` per range and key of ``key_ranges``' rows, for keys that lie in several ranges: at most two rows a range."""
    per = ranged.groupBy(RANGE, key).agg(*aggs)
    return per.withColumn("__ranges", F.count(F.lit(1)).over(Window.partitionBy(key))).filter("__ranges > 1").drop("__ranges")


def asof_lookup(fact: DataFrame, dim: DataFrame, key: str, ts: str, sk: str,
                valid_from: str = "effective_from", valid_to: str = "effective_to",
                fact_key: str | None = None) -> DataFrame:
    """Attach the surrogate key of the dimension version valid at ``ts``.

    The version with ``valid_from <= ts < coalesce(valid_to, OPEN_END)``
    wins; when none covers ``ts`` (e.g. the fact predates the first version)
    the key's earliest version is used (NULL ``valid_from`` first, then the
    lower surrogate key). Facts whose key has no version at all are dropped
    (inner-join semantics).

    Plan: the dimension is turned into intervals that tile the time line
    per key (``lookup_intervals``) and staged. A fact meets the intervals of its key in one equi-join
    with a range condition, each fact row matching exactly one interval. Both
    inputs of the join are shuffle stages, so AQE can split a key
    that holds a large share of the facts, and no window runs over these facts.

    A fact of a key with over ``BIN`` intervals is not compared with all of them: these
    keys' facts and intervals are sorted together by key and time, in ranges of about equal
    size, and a fact takes the last interval that began (``_by_order``). So neither
    a key with many versions nor one with many facts is one task's work, and the work grows
    with facts and versions, not with their product.
    """
    fk = fact_key or key
    most = most_versions(dim, key)
    iv = lookup_intervals(dim, key, sk, valid_from, valid_to, most)
    iv = materialize(iv.select(F.col(key).alias("__i_key"), F.col("lo").alias("__lo"), F.col("hi").alias("__hi"), F.col(sk).alias("__i_sk"),
                               F.col("null_ts").alias("__null_ts")), "lookup_intervals")
    out = [F.col(f"`{c}`") for c in fact.columns if c != sk] + [F.col("__i_sk").alias(sk)]
    if 2 * most + 1 <= BIN:     # a version and the gap before it, and the gap behind the last
        return _by_interval(fact, iv, fk, ts).select(*out)
    many = materialize(iv.groupBy("__i_key").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > BIN).select("__i_key"), "keys_of_many")
    n = many.count()
    if not n:
        return _by_interval(fact, iv, fk, ts).select(*out)
    hot = many.select(F.col("__i_key").alias("__m_key"))
    hot = F.broadcast(hot) if n <= BROADCAST_BINS else hot
    flagged = fact.filter(F.col(fk).isNotNull()).join(hot, F.col(fk) == F.col("__m_key"), "left")
    # a fact without a time meets the one interval for it
    plain = flagged.filter(F.col("__m_key").isNull() | F.col(ts).isNull()).drop("__m_key")
    sorted_ = flagged.filter(F.col("__m_key").isNotNull() & F.col(ts).isNotNull())
    few = iv.join(hot, F.col("__i_key") == F.col("__m_key"), "left").filter(F.col("__m_key").isNull() | F.col("__null_ts")).drop("__m_key")
    of_many = iv.join(hot, F.col("__i_key") == F.col("__m_key"), "left_semi")
    return _by_interval(plain, few, fk, ts).select(*out).unionByName(_by_order(sorted_, of_many, "__m_key", ts).select(*out))


def _by_interval(fact: DataFrame, iv: DataFrame, fk: str, ts: str) -> DataFrame:
    """Each fact with the interval of its key that holds its time."""
    t = F.col(ts)
    in_range = ((F.col("__lo").isNull() | (t >= F.col("__lo"))) & (F.col("__hi").isNull() | (t < F.col("__hi"))))
    cond = ((F.col(fk) == F.col("__i_key")) & (F.col("__f_salt") == F.col("__i_salt"))
            & F.when(t.isNull(), F.col("__null_ts")).otherwise(in_range))
    facts = fact.withColumn("__f_salt", null_key_salt([fk], [fk]))
    return facts.join(iv.withColumn("__i_salt", null_key_salt(["__i_key"], ["__i_key"])), cond, "inner")


def _by_order(fact: DataFrame, iv: DataFrame, fk: str, ts: str) -> DataFrame:
    """Each fact (with a time) with the sk of its key's last interval that began by then.

    Facts and intervals are cut into ranges of (key, time); facts of one time are spread by a hash.
    What a range of a key begins with is handed on from the ranges before it: one row per range.
    """
    time_type = fact.select(F.col(ts).alias("__t")).crossJoin(iv.select("__lo")).select(F.greatest("__t", "__lo").alias("t")).schema["t"].dataType
    flat = [f.name for f in fact.schema.fields if not isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType))]
    row = F.struct(*[F.col(f"`{c}`") for c in fact.columns])
    facts = fact.select(F.col(fk).alias("__k"), F.col(ts).cast(time_type).alias("__t"), F.lit(1).alias("__kind"),
                        F.xxhash64(*[F.col(f"`{c}`") for c in flat]).alias("__spread"), row.alias("__row"), typed_null(iv.schema["__i_sk"].dataType).alias("__i_sk"))
    starts = iv.select(F.col("__i_key").alias("__k"), F.col("__lo").cast(time_type).alias("__t"), F.lit(0).alias("__kind"), F.lit(0).cast("long").alias("__spread"),
                       typed_null(facts.schema["__row"].dataType).alias("__row"), "__i_sk")
    ranged = key_ranges(facts.unionByName(starts), "__k", ["__t", "__kind", "__spread"])
    order = Window.partitionBy("__k").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    begun = F.when(F.col("__kind") == 0, F.struct("__t", F.col("__i_sk").alias("sk")))
    last = _in_several(ranged, "__k", F.max(begun).alias("__begun"))
    last = last.select(F.col(RANGE).alias("__b_range"), F.col("__k").alias("__b_key"), F.last("__begun", ignorenulls=True).over(order).alias("__before"))
    w = Window.partitionBy(RANGE, "__k").orderBy(F.col("__t").asc_nulls_first(), "__kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = ranged.withColumn("__here", F.last(F.when(F.col("__kind") == 0, F.struct(F.col("__i_sk").alias("sk"))), ignorenulls=True).over(w))
    here = here.filter(F.col("__kind") == 1).join(F.broadcast(last), (F.col(RANGE) == F.col("__b_range")) & (F.col("__k") == F.col("__b_key")), "left")
    sk = F.when(F.col("__here").isNotNull(), F.col("__here.sk")).otherwise(F.col("__before.sk"))
    return here.select("__row.*", sk.alias("__i_sk"))


def unknown_member(fact: DataFrame, dim: DataFrame, key: str, sk: str,
                   default: int = UNKNOWN_SK, fact_key: str | None = None) -> DataFrame:
    """Left join to a dimension unique on ``key``; no match → ``sk = default``."""
    fk = fact_key or key
    d = dim.select(F.col(key).alias("__u_key"), F.col(sk).alias("__u_sk"))
    d = d.withColumn("__u_salt", null_key_salt(["__u_key"], ["__u_key"]))
    # NULL keys cannot match; the salt spreads them instead of piling them into one task
    f = fact.withColumn("__f_salt", null_key_salt([fk], fact.columns))
    j = f.join(d, (F.col(fk) == F.col("__u_key")) & (F.col("__f_salt") == F.col("__u_salt")), "left")
    default_sk = F.lit(default).cast(dim.schema[sk].dataType)
    return (j.withColumn(sk, F.coalesce(F.col("__u_sk"), default_sk))
             .drop("__u_key", "__u_sk", "__u_salt", "__f_salt"))


FACT_COLUMNS = ["order_id", "date_key", "customer_sk", "product_sk", "quantity", "unit_price",
                "total_amount", "status", "order_ts", "source"]


def fact_orders(orders: DataFrame, dim_customer: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Order-grain fact: date key, SCD2-aware customer key, product key (−1 unknown)."""
    # nothing else of the orders is shuffled: the salt of NULL keys reads every column it is given
    needed = [c for c in FACT_COLUMNS if c in orders.columns and c not in ("date_key", "customer_sk", "product_sk")]
    f = asof_lookup(orders.select("customer_id", "product_id", *needed), dim_customer, "customer_id", "order_ts", "customer_sk",
                    fact_key="customer_id")
    f = unknown_member(f, dim_product, "product_id", "product_sk", fact_key="product_id")
    return f.withColumn("date_key", date_key("order_ts")).select(*FACT_COLUMNS)


def daily_sales(fact: DataFrame, dim_product: DataFrame,
                statuses: Sequence[str] = ("completed", "shipped")) -> DataFrame:
    """Mart by ``(date_key, category)``: distinct orders, units, revenue.

    Revenue is summed exactly (decimals of eight places) and rounded to cents
    once, so lines of less than a cent count and it does not depend on summation order (a double sum can
    differ run to run in the last bits) and keeps the reference's type.
    Unknown products (sk −1) fall into the NULL category.
    """
    f = fact.filter(F.col("status").isin(list(statuses)))
    p = dim_product.select(F.col("product_sk").alias("__p_sk"), "category")
    j = f.join(p, f["product_sk"] == F.col("__p_sk"), "left")
    return (j.groupBy("date_key", "category")
             .agg(F.countDistinct("order_id").alias("orders_count"),
                  F.sum("quantity").cast("long").alias("units_sold"),
                  F.round(F.sum(F.col("total_amount").cast("decimal(26,8)")), 2).cast("double").alias("revenue")))
