"""Fact and mart by changes against full builds, over random second runs."""

import random
import re
from datetime import datetime, timedelta

import pytest

from conftest import rows
from strata.operators.incremental import changed_groups, changed_keys, fact_changes, refresh_daily_sales, refresh_fact
from strata.operators.star import daily_sales, fact_orders
from strata.sinks.store import materialize

ORDERS = ("order_id string, customer_id bigint, product_id bigint, quantity int, unit_price double, total_amount double, status string, "
          "order_ts timestamp_ntz, source string, updated_at timestamp_ntz")
CUSTOMERS = "customer_sk bigint, customer_id bigint, effective_from timestamp_ntz, effective_to timestamp_ntz"
PRODUCTS = "product_sk bigint, product_id bigint, category string"
T = datetime(2024, 1, 1)


def _runs(seed):
    r = random.Random(seed)
    order = lambda i: (f"o{i}", r.choice([1, 2, 3, 4, 99]), r.choice([10, 11, 12, 77]), r.randint(1, 5), 1.0, r.randint(1, 9) / 4,
                       r.choice(["completed", "shipped", "cancelled"]), T + timedelta(days=r.randint(0, 6)), "batch", T)
    before = {i: order(i) for i in range(60)}
    touched = r.sample(range(70), 12)
    after = dict(before)
    for i in touched:
        if i % 4 == 0:
            after.pop(i, None)  # deleted
        else:
            after[i] = order(i)
    c1 = [(1, 1, T, None), (2, 2, T, None), (3, 3, T + timedelta(days=2), None)]
    c2 = [(1, 1, T, T + timedelta(days=3)), (4, 1, T + timedelta(days=3), None), (2, 2, T, None), (3, 3, T + timedelta(days=2), None), (5, 4, T, None)]
    p1 = [(10, 10, "toys"), (11, 11, "food"), (12, 12, None)]
    p2 = [(10, 10, "toys"), (11, 11, "tools"), (77, 77, "new")]
    return list(before.values()), list(after.values()), [(f"o{i}",) for i in touched] + [(None,), ("o1",)] * (1 in touched), c1, c2, p1, p2


@pytest.mark.parametrize("seed", [1, 2])
def test_changes_equal_a_full_build(spark, seed):
    before, after, touched, c1, c2, p1, p2 = _runs(seed)
    o1, o2 = spark.createDataFrame(before, ORDERS), spark.createDataFrame(after, ORDERS)
    c1, c2 = (spark.createDataFrame(c, CUSTOMERS) for c in (c1, c2))
    p1, p2 = (spark.createDataFrame(p, PRODUCTS) for p in (p1, p2))
    fact = materialize(fact_orders(o1, c1, p1), "t_fact")
    mart = materialize(daily_sales(fact, p1), "t_mart")
    changes = fact_changes(o2, spark.createDataFrame(touched, "order_id string"), c1, c2, p1, p2)
    now = refresh_fact(fact, changes)
    full = fact_orders(o2, c2, p2)
    assert rows(now) == rows(full.select(*now.columns))
    groups = changed_groups(fact, changes, p1, p2)
    assert rows(refresh_daily_sales(mart, full, p2, groups)) == rows(daily_sales(full, p2).select(*mart.columns))


def test_nothing_changed_touches_nothing(spark):
    before, _, _, c1, _, p1, _ = _runs(3)
    o, c, p = spark.createDataFrame(before, ORDERS), spark.createDataFrame(c1, CUSTOMERS), spark.createDataFrame(p1, PRODUCTS)
    fact = materialize(fact_orders(o, c, p), "t_fact")
    changes = fact_changes(o, o.filter("false"), c, c, p, p)
    assert changes.redone.isEmpty() and changes.rows.isEmpty()
    assert changed_groups(fact, changes, p, p).isEmpty()
    assert rows(refresh_fact(fact, changes)) == rows(fact)


def test_changed_keys_see_nulls_and_repeats(spark):
    S = "k int, v string"
    a = spark.createDataFrame([(1, None), (2, "x"), (2, "x"), (3, "y"), (None, "z")], S)
    b = spark.createDataFrame([(1, None), (2, "x"), (3, None), (4, "n")], S)
    assert rows(changed_keys(a, b, "k", ["v"])) == [(2,), (3,), (4,)]


def test_orders_and_facts_are_shuffled_once(spark):
    """Few changed customers and products shuffle no orders, replacing facts shuffles the fact and the ids alone, and dates move no facts."""
    before, after, touched, c1, c2, p1, p2 = _runs(4)
    o1, o2 = spark.createDataFrame(before, ORDERS), spark.createDataFrame(after, ORDERS)
    c1, c2 = (spark.createDataFrame(c, CUSTOMERS) for c in (c1, c2))
    p1, p2 = (spark.createDataFrame(p, PRODUCTS) for p in (p1, p2))
    fact = materialize(fact_orders(o1, c1, p1), "t_fact")
    changes = fact_changes(o2, spark.createDataFrame(touched, "order_id string"), c1, c2, p1, p2)
    now = refresh_fact(fact, changes)
    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert exchanges(now) == 2
    mart = materialize(daily_sales(fact, p1), "t_mart")
    again = refresh_daily_sales(mart, fact, p1, mart.select("date_key", "category"))
    by_date = r"Exchange hashpartitioning\(coalesce\(date_key#\d+, 0\), isnull\(date_key#\d+\), \d+\)"
    assert not re.search(by_date, again._jdf.queryExecution().executedPlan().toString())
    assert rows(again) == rows(mart)
