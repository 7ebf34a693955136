import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import d, rows, ts
from strata.operators.keys import assign_surrogate_keys, key_ranges
from strata.operators.scd import empty_dim, scd1, scd2_apply, scd2_changes, scd2_close
from strata.plans.medallion import CUSTOMER_ATTRS, DIM_CUSTOMER_SCHEMA, SCD2_TRACKED

SRC = ("customer_id bigint, full_name string, email string, city string, segment string, "
       "signup_date date, updated_at timestamp_ntz")


def _src(spark, data):
    return spark.createDataFrame(data, SRC)


def _run(dim, src):
    return scd2_apply(dim, src, "customer_id", SCD2_TRACKED, CUSTOMER_ATTRS, "customer_sk")


def test_scd2_cases(spark):
    t0, t1 = ts("2024-01-01 00:00:00"), ts("2024-02-01 00:00:00")
    s1 = _src(spark, [
        (1, "A", "a@x", "Paris", "S1", d("2020-01-01"), t0),   # will change city
        (2, "B", "b@x", "Rome", "S1", d("2020-01-01"), t0),    # unchanged
        (3, "C", "c@x", "Oslo", "S1", d("2020-01-01"), t0),    # signup_date-only change
        (4, "D", "d@x", None, "S1", d("2020-01-01"), t0),      # NULL → value (not a change)
        (5, "E", "e@x", "Kyiv", "S1", d("2020-01-01"), t0),    # change with equal updated_at
    ])
    dim1 = _run(empty_dim(spark, DIM_CUSTOMER_SCHEMA), s1)
    assert rows(dim1, "customer_id", "customer_sk", "is_current") == [(i, i, True) for i in range(1, 6)]
    s2 = _src(spark, [
        (1, "A", "a@x", "Berlin", "S1", d("2020-01-01"), t1),
        (2, "B", "b@x", "Rome", "S1", d("2020-01-01"), t1),
        (3, "C", "c@x", "Oslo", "S1", d("2021-01-01"), t1),
        (4, "D", "d@x", "Lima", "S1", d("2020-01-01"), t1),
        (5, "E", "e@x", "Oslo", "S1", d("2020-01-01"), t0),
        (6, "F", "f@x", "Nice", "S2", d("2020-01-01"), t1),    # new
    ])
    dim2 = _run(dim1, s2)
    got = rows(dim2, "customer_sk", "customer_id", "city", "effective_from", "effective_to", "is_current")
    assert got == sorted([
        (1, 1, "Paris", t0, t1, False),
        (2, 2, "Rome", t0, None, True),
        (3, 3, "Oslo", t0, None, True),
        (4, 4, None, t0, None, True),
        (5, 5, "Kyiv", t0, t0, False),        # zero-length version [t0, t0)
        (6, 1, "Berlin", t1, None, True),     # max_sk + row_number by customer_id
        (7, 5, "Oslo", t0, None, True),
        (8, 6, "Nice", t1, None, True),
    ], key=repr)
    # a second run with the same state changes nothing
    assert _run(dim2, s2).exceptAll(dim2).count() == 0


def test_null_safe_change_detection_is_opt_in(spark):
    t0 = ts("2024-01-01 00:00:00")
    dim = _run(empty_dim(spark, DIM_CUSTOMER_SCHEMA),
               _src(spark, [(4, "D", "d@x", None, "S1", d("2020-01-01"), t0)]))
    src = _src(spark, [(4, "D", "d@x", "Lima", "S1", d("2020-01-01"), t0)])
    assert scd2_changes(dim, src, "customer_id", SCD2_TRACKED).count() == 0
    assert scd2_changes(dim, src, "customer_id", SCD2_TRACKED, null_safe=True).count() == 1


def test_scd1_overwrites_and_inserts(spark):
    P = "product_sk bigint, product_id bigint, name string"
    dim = spark.createDataFrame([(1, 1, "old"), (2, 2, "keep")], P)
    src = spark.createDataFrame([(1, "new"), (3, "ins")], "product_id bigint, name string")
    assert rows(scd1(dim, src, "product_id", sk="product_sk")) == [(1, 1, "new"), (2, 2, "keep"), (3, 3, "ins")]


def test_surrogate_keys_equal_global_row_number(spark):
    rnd = random.Random(7)
    keys = rnd.sample(range(-10_000, 1_000_000), 3000) + [None]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    expect = df.withColumn("sk", 41 + F.row_number().over(Window.orderBy(F.col("k").asc_nulls_first())))
    for buckets in (1, 7, 4096):
        got = assign_surrogate_keys(df, "k", out="sk", start=41, ranges=buckets)
        assert got.exceptAll(expect).count() == 0 and expect.exceptAll(got).count() == 0


def test_surrogate_keys_start_from_a_one_row_frame(spark):
    df = spark.createDataFrame([(5,), (3,)], "k int")
    start = spark.createDataFrame([(100,)], "max_sk bigint")
    assert rows(assign_surrogate_keys(df, "k", start=start)) == [(3, 101), (5, 102)]


def test_surrogate_keys_on_string_keys_equal_global_row_number(spark):
    rnd = random.Random(3)
    keys = [f"ORD-{rnd.randint(0, 10**9):010d}" for _ in range(2000)] + ["ORD-", "ORD-9", "ORDé", None]
    keys += [f"X{rnd.random()}" for _ in range(200)]
    df = spark.createDataFrame([(k,) for k in set(keys)], "k string")
    expect = df.withColumn("sk", F.row_number().over(Window.orderBy(F.col("k").asc_nulls_first())))
    for buckets in (3, 512):
        got = assign_surrogate_keys(df, "k", out="sk", ranges=buckets)
        assert got.exceptAll(expect).count() == 0 and expect.exceptAll(got).count() == 0


def test_key_ranges_stay_even_with_outliers_and_shared_prefixes(spark):
    longs = spark.range(20_000).select(F.when(F.col("id") == 0, 1 << 60).when(F.col("id") == 1, -(1 << 62)).otherwise(F.col("id")).alias("k"))
    texts = spark.range(20_000).select(F.concat(F.lit("the same long prefix "), F.col("id").cast("string")).alias("k"))
    for df in (longs, texts):
        sizes = [r[0] for r in key_ranges(df, "k", ranges=20).groupBy("__sk_range").count().select("count").collect()]
        assert sum(sizes) == 20_000 and max(sizes) < 4_000


def test_close_does_not_shuffle_the_closed_history(spark):
    t0 = ts("2024-01-01 00:00:00")
    dim = spark.createDataFrame([(1, 1, t0, t0, False), (2, 1, t0, None, True), (3, 2, t0, None, None)],
                                "sk long, k long, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean")
    changes = spark.createDataFrame([(1, ts("2024-03-01 00:00:00")), (2, t0)], "k long, updated_at timestamp_ntz")
    got = rows(scd2_close(dim, changes, "k"), "sk", "effective_to", "is_current")
    assert got == sorted([(1, t0, False), (2, ts("2024-03-01 00:00:00"), False), (3, None, None)], key=repr)
