"""Fact and mart kept up to date by what a run changed.

A run touches some orders, opens and closes some customer versions and loads some
products. Facts of anything else stay as they are, and so do the mart's groups
that no changed fact is or was in.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.star import daily_sales, fact_orders
from strata.sinks.store import materialize

#: Keys of changed customers, products or dates that are broadcast at most (one column); more are joined by a shuffle.
BROADCAST_KEYS = 1_000_000


def changed_keys(before: DataFrame, after: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Keys whose rows, seen through ``cols``, are not the same in both tables (as often, NULLs alike)."""
    both = before.select(key, *cols, F.lit(-1).alias("__n")).unionByName(after.select(key, *cols, F.lit(1).alias("__n")))
    return both.groupBy(key, *cols).agg(F.sum("__n").alias("__n")).filter("__n <> 0").select(key).filter(F.col(key).isNotNull()).distinct()


@dataclass
class FactChanges:
    """``redone``: order ids looked up again; ``rows``: their facts now (an order without one has none any more)."""

    redone: DataFrame
    rows: DataFrame


def fact_changes(orders: DataFrame, touched: DataFrame, customers_before: DataFrame, customers_after: DataFrame,
                 products_before: DataFrame, products_after: DataFrame) -> FactChanges:
    """The facts that a run may have changed.

    ``touched`` holds the ``order_id`` of every order that the run inserted, updated
    or deleted. Looked up again are those, the orders of customers whose
    versions changed and those of products that appeared or went. The ids found are staged; the orders
    are shuffled once, to meet them (and by customer or product only if more than ``BROADCAST_KEYS`` of these changed).
    """
    moved = changed_keys(customers_before, customers_after, "customer_id", ["customer_sk", "effective_from", "effective_to"])
    loaded = changed_keys(products_before, products_after, "product_id", ["product_sk"])
    known = orders.filter(F.col("order_id").isNotNull())
    ids = touched.select("order_id").filter(F.col("order_id").isNotNull())
    for keys, key, name in ((moved, "customer_id", "moved_customers"), (loaded, "product_id", "loaded_products")):
        ids = ids.union(_with_key(known, materialize(keys, name), key).select("order_id"))
    redone = materialize(ids.distinct(), "redone_orders")
    again = known.join(redone, "order_id", "left_semi")
    return FactChanges(redone, materialize(fact_orders(again, customers_after, products_after), "facts_again"))


def _with_key(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is in the staged ``keys``."""
    return rows.filter(F.col(key).isNotNull()).join(F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys, key, "left_semi")


def refresh_fact(fact: DataFrame, changes: FactChanges) -> DataFrame:
    """The fact with ``changes`` applied: the facts of the orders looked up again are replaced by what was found.

    That is a MERGE which updates, inserts and deletes, but each table is shuffled at most once.
    """
    return fact.join(changes.redone, "order_id", "left_anti").select(*fact.columns).unionByName(changes.rows.select(*fact.columns))


def changed_groups(fact_before: DataFrame, changes: FactChanges, products_before: DataFrame, products_after: DataFrame) -> DataFrame:
    """(date_key, category) that a changed fact is or was in, or that a product's other category moves facts between."""
    def groups(facts: DataFrame, products: DataFrame) -> DataFrame:
        p = products.select(F.col("product_sk").alias("__p_sk"), "category")
        return facts.join(p, F.col("product_sk") == F.col("__p_sk"), "left").select("date_key", "category")

    recast = materialize(changed_keys(products_before, products_after, "product_sk", ["category"]), "recast_products")
    was = fact_before.join(changes.redone, "order_id", "left_semi")
    stays = _with_key(fact_before, recast, "product_sk")
    every = groups(was, products_before)
    for facts, products in ((changes.rows, products_after), (stays, products_before), (stays, products_after)):
        every = every.union(groups(facts, products))
    return every.distinct()


def refresh_daily_sales(mart: DataFrame, fact: DataFrame, products: DataFrame, groups: DataFrame) -> DataFrame:
    """The mart with its ``groups`` computed again from the facts of their dates; the others are kept as they are."""
    g = materialize(groups.select(F.col("date_key").alias("__g_date"), F.col("category").alias("__g_category")), "mart_groups")
    same = F.col("date_key").eqNullSafe(F.col("__g_date")) & F.col("category").eqNullSafe(F.col("__g_category"))
    dates = materialize(g.select("__g_date").distinct(), "mart_dates")
    dates = F.broadcast(dates) if dates.count() <= BROADCAST_KEYS else dates
    near = fact.join(dates, F.col("date_key").eqNullSafe(F.col("__g_date")), "left_semi")
    again = daily_sales(near, products).join(g, same, "left_semi")
    return mart.join(g, same, "left_anti").unionByName(again.select(*mart.columns))
