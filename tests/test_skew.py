"""A key holding a third of the rows is split by AQE, not processed by one task."""

import re

from datetime import datetime, timedelta

from strata.operators.star import asof_lookup

SKEW_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


def test_hot_customer_is_split_in_asof_join(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        base = datetime(2024, 1, 1)
        dim = spark.createDataFrame(
            [(c * 2 + 1, c, base, base + timedelta(days=10)) for c in range(200)]
            + [(c * 2 + 2, c, base + timedelta(days=10), None) for c in range(200)],
            "customer_sk bigint, customer_id bigint, effective_from timestamp_ntz, effective_to timestamp_ntz")
        n = 30000
        fact = spark.range(n).selectExpr(
            "CAST(id AS STRING) AS order_id",
            "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 200 END AS customer_id",   # customer 7: a third
            "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(CAST(id % 20 AS INT), 0, 0, 0) AS order_ts")
        out = asof_lookup(fact, dim, "customer_id", "order_ts", "customer_sk")
        assert len(out.collect()) == n          # runs this Dataset's own adaptive plan
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan, plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_product_is_split_in_unknown_member_join(spark):
    from strata.operators.star import unknown_member
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        dim = spark.range(300).selectExpr("id AS product_sk", "id AS product_id")
        fact = spark.range(30000).selectExpr(
            "CAST(id AS STRING) AS order_id",
            "CASE WHEN id % 3 = 0 THEN 5 WHEN id % 7 = 0 THEN NULL ELSE id % 400 END AS product_id")
        out = unknown_member(fact, dim, "product_id", "product_sk")
        got = out.collect()
        assert len(got) == 30000
        assert {r.product_sk for r in got if r.product_id is None or r.product_id >= 300} == {-1}
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_null_keys_are_spread_by_a_real_join_key(spark):
    """The NULL-key salt must stay an equi-join key (not folded into a filter)."""
    from strata.operators.merge import merge_upsert
    from strata.operators.star import unknown_member
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        dim = spark.range(10).selectExpr("id AS product_sk", "id AS product_id")
        fact = spark.range(100).selectExpr("id AS order_id", "CASE WHEN id % 3 = 0 THEN NULL ELSE id END AS product_id")
        def plan_of(df):
            return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())
        plan = plan_of(unknown_member(fact, dim, "product_id", "product_sk"))
        assert "SortMergeJoin [product_id, __f_salt], [__u_key, __u_salt], LeftOuter" in plan, plan
        t = spark.range(100).selectExpr("CASE WHEN id % 3 = 0 THEN NULL ELSE id END AS k", "id AS v")
        s = spark.range(50).selectExpr("CASE WHEN id % 5 = 0 THEN NULL ELSE id END AS k", "id AS v")
        plan = plan_of(merge_upsert(t, s, "k"))
        assert "SortMergeJoin [__t_k, __t_salt], [__s_k, __s_salt], FullOuter" in plan, plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
