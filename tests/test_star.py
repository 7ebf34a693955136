from conftest import rows, ts

from strata.operators.star import asof_lookup, daily_sales, unknown_member

DIM = "customer_sk bigint, customer_id bigint, effective_from timestamp_ntz, effective_to timestamp_ntz"


def test_asof_cases(spark):
    t1, t2 = ts("2024-01-10 00:00:00"), ts("2024-02-01 00:00:00")
    dim = spark.createDataFrame([(1, 7, t1, t2), (2, 7, t2, None), (3, 8, t1, None)], DIM)
    fact = spark.createDataFrame([
        ("before", 7, ts("2024-01-01 00:00:00")),   # before first version → earliest (1)
        ("inside", 7, ts("2024-01-20 00:00:00")),   # inside old version → 1
        ("boundary", 7, t2),                        # exactly at boundary → new version (2)
        ("after", 7, ts("2030-01-01 00:00:00")),    # after last change → current (2)
        ("unknown", 99, t2),                        # unknown customer → dropped
        ("other", 8, ts("2024-03-01 00:00:00")),
    ], "order_id string, customer_id bigint, order_ts timestamp_ntz")
    out = asof_lookup(fact, dim, "customer_id", "order_ts", "customer_sk")
    assert rows(out, "order_id", "customer_sk") == sorted(
        [("before", 1), ("inside", 1), ("boundary", 2), ("after", 2), ("other", 3)], key=repr)


def test_earliest_fallback_puts_null_effective_from_first(spark):
    dim = spark.createDataFrame([(1, 7, ts("2024-01-10 00:00:00"), None), (2, 7, None, None)], DIM)
    fact = spark.createDataFrame([("o", 7, None)], "order_id string, customer_id bigint, order_ts timestamp_ntz")
    assert rows(asof_lookup(fact, dim, "customer_id", "order_ts", "customer_sk"), "customer_sk") == [(2,)]


def test_unknown_member_and_mart(spark):
    dimp = spark.createDataFrame([(10, 10, "toys")], "product_sk bigint, product_id bigint, category string")
    fact = spark.createDataFrame([("a", 10), ("b", 11)], "order_id string, product_id bigint")
    assert rows(unknown_member(fact, dimp, "product_id", "product_sk"), "order_id", "product_sk") == \
        [("a", 10), ("b", -1)]
    f = spark.createDataFrame([
        ("a", 20240101, 10, 2, 10.10, "completed"), ("b", 20240101, -1, 1, 0.2, "shipped"),
        ("c", 20240101, 10, 5, 1.0, "cancelled"), ("d", 20240101, 10, 1, 0.2, "shipped"),
    ], "order_id string, date_key int, product_sk bigint, quantity int, total_amount double, status string")
    got = rows(daily_sales(f, dimp), "date_key", "category", "orders_count", "units_sold", "revenue")
    assert set(got) == {(20240101, None, 1, 1, 0.2), (20240101, "toys", 2, 3, 10.3)}


def test_asof_equals_the_definition(spark):
    """The interval join against the definition, fact by fact, in Python."""
    import random
    from datetime import datetime, timedelta
    rnd = random.Random(11)
    base = datetime(2024, 1, 1)
    dim, sk = [], 0
    for key in range(60):
        t = base + timedelta(days=rnd.randint(0, 20))
        for v in range(rnd.randint(1, 4)):
            sk += 1
            frm = None if rnd.random() < 0.05 else t
            step = rnd.choice([0, 0, 3, 10])                       # zero-length versions too
            to = t + timedelta(days=step)
            gap = timedelta(days=rnd.choice([0, 0, 0, 2]))         # occasional gaps
            dim.append((sk, key, frm, to))
            t = to + gap
        if rnd.random() < 0.7:
            dim[-1] = (dim[-1][0], dim[-1][1], dim[-1][2], None)   # open current version
    facts = [(f"o{i}", rnd.randint(0, 65),
              None if rnd.random() < 0.03 else base + timedelta(days=rnd.randint(-5, 60), hours=rnd.randint(0, 23)))
             for i in range(3000)]
    d = spark.createDataFrame(dim, DIM)
    f = spark.createDataFrame(facts, "order_id string, customer_id bigint, order_ts timestamp_ntz")
    got = asof_lookup(f, d, "customer_id", "order_ts", "customer_sk").select("order_id", "customer_sk")

    def expected(key, t):
        versions = sorted((v for v in dim if v[1] == key), key=lambda v: (v[2] is not None, v[2] or base, v[0]))
        covering = [v for v in versions if t and v[2] and v[2] <= t and (v[3] is None or t < v[3])]
        return (covering or versions)[0][0] if versions else None

    want = {o: expected(k, t) for o, k, t in facts}
    found = got.collect()
    assert len(found) == len({r.order_id for r in found})
    assert {r.order_id: r.customer_sk for r in found} == {o: sk for o, sk in want.items() if sk is not None}


def test_overlapping_versions_give_one_row_per_fact(spark):
    import datetime as dt
    from strata.operators.star import asof_lookup
    day = lambda n: dt.datetime(2024, 1, n)
    dim = spark.createDataFrame([(1, 10, day(1), day(20)), (1, 11, day(5), None), (1, 12, day(6), None), (2, 20, day(3), None), (2, 21, day(3), None)],
                                "k int, sk long, effective_from timestamp_ntz, effective_to timestamp_ntz")
    fact = spark.createDataFrame([(i, k, day(t)) for i, (k, t) in enumerate([(1, 2), (1, 7), (1, 25), (2, 1), (2, 4)])],
                                 "id int, k int, t timestamp_ntz")
    got = asof_lookup(fact, dim, "k", "t", "sk")
    assert sorted((r.id, r.sk) for r in got.collect()) == [(0, 10), (1, 10), (2, 11), (3, 20), (4, 20)]


def test_many_versions_of_one_key_are_cut_into_bins(spark, monkeypatch):
    """Bins of three intervals, broadcast and shuffled, against the definition; gaps, overlaps and facts without a time among them."""
    import random
    from datetime import datetime, timedelta
    from strata.operators import star
    rnd = random.Random(5)
    base = datetime(2024, 1, 1)
    dim = [(i, 7, base + timedelta(hours=rnd.randint(0, 900)), None if i == 50 else base + timedelta(hours=rnd.randint(0, 950))) for i in range(80)]
    dim += [(100, 8, base, base + timedelta(days=1)), (101, None, base, None), (102, 9, None, None)]
    facts = [(f"o{i}", rnd.choice([7, 7, 8, 9, 10, None]), None if i % 50 == 0 else base + timedelta(minutes=rnd.randint(-3000, 70000))) for i in range(1500)]
    d, f = spark.createDataFrame(dim, DIM), spark.createDataFrame(facts, "order_id string, customer_id bigint, order_ts timestamp_ntz")

    def expected(key, t):
        versions = sorted((v for v in dim if v[1] == key), key=lambda v: (v[2] is not None, v[2] or base, v[0]))
        covering = [v for v in versions if t and v[2] and v[2] <= t and (v[3] is None or t < v[3])]
        return (covering or versions)[0][0] if versions else None

    want = sorted((o, expected(k, t)) for o, k, t in facts if k is not None and expected(k, t) is not None)
    monkeypatch.setattr(star, "BIN", 3)
    for rows_ in (200_000, 0):
        monkeypatch.setattr(star, "BROADCAST_BINS", rows_)
        assert sorted(tuple(r) for r in asof_lookup(f, d, "customer_id", "order_ts", "customer_sk").select("order_id", "customer_sk").collect()) == want
    assert asof_lookup(f, d.filter("false"), "customer_id", "order_ts", "customer_sk").count() == 0
    assert asof_lookup(f.filter("false"), d, "customer_id", "order_ts", "customer_sk").count() == 0


def test_versions_and_facts_of_one_key_are_spread_over_ranges(spark, monkeypatch):
    """The windows run over ranges of a key with many versions, and what the ranges hand on gives the result of one window."""
    import random
    from datetime import datetime, timedelta
    from strata.operators import star
    from strata.operators.keys import RANGE
    rnd = random.Random(11)
    base = datetime(2024, 1, 1)
    dim = [(i, 7, base + timedelta(hours=rnd.randint(0, 900)), base + timedelta(hours=rnd.randint(0, 950))) for i in range(150)]
    dim += [(150, 7, None, None), (151, 7, base + timedelta(hours=10), base + timedelta(hours=700)), (152, 8, base, None)]
    facts = [(i, rnd.choice([7, 7, 7, 8]), base + timedelta(hours=rnd.choice([5, 5, 300, rnd.randint(-50, 1000)]))) for i in range(800)]
    d, f = spark.createDataFrame(dim, DIM), spark.createDataFrame(facts, "id int, customer_id bigint, order_ts timestamp_ntz")
    one = sorted(map(tuple, star.lookup_intervals(d, "customer_id", "customer_sk").collect()), key=str)
    want = sorted(map(tuple, asof_lookup(f, d, "customer_id", "order_ts", "customer_sk").select("id", "customer_sk").collect()))
    assert len(want) == 800
    monkeypatch.setattr(star, "MANY", 5)
    spread = star.lookup_intervals(d, "customer_id", "customer_sk")
    assert f"windowspecdefinition({RANGE}" in spread._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, spread.collect()), key=str) == one
    monkeypatch.setattr(star, "BIN", 3)
    got = asof_lookup(f, d, "customer_id", "order_ts", "customer_sk")
    assert f"windowspecdefinition({RANGE}" in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, got.select("id", "customer_sk").collect())) == want
