import pytest
from pyspark.sql import functions as F

from conftest import rows
from strata.operators import expectations as ex
from strata.operators import quality as dq


def _tables(spark):
    return {
        "empty": spark.createDataFrame([], "id int"),
        "orders": spark.createDataFrame([(None, 1, 5.0), (1, 2, None), (1, 2, 1.0), (1, 3, -1.0), (2, 9, 0.0)],
                                        "order_id int, customer_id int, amount double"),
        "customers": spark.createDataFrame([(1,), (2,), (3,)], "customer_id int"),
        "nulls": spark.createDataFrame([(None,), (3.0,)], "amount double"),
        "dim": spark.createDataFrame([(1, True), (1, True), (2, False), (3, True)], "id int, is_current boolean"),
    }


def test_quality_cases(spark):
    checks = [
        dq.not_empty("empty_table", "empty"),
        dq.null_keys("null_key", "orders", ["order_id"]),
        dq.duplicates("triple_duplicate", "orders", "order_id"),
        dq.predicate("null_measure_is_no_violation", "nulls", "amount < 0", dq.WARN),
        dq.predicate("negative", "orders", F.col("amount") < 0, dq.WARN),
        dq.ref_integrity("orphan", "orders", "customer_id", "customers"),
        dq.single_current("two_current", "dim", "id"),
    ]
    res = dq.run_checks(_tables(spark), checks, "test")
    got = dict(rows(res, "check_name", "violations"))
    assert got == {"empty_table": 1, "null_key": 1, "triple_duplicate": 2, "null_measure_is_no_violation": 0,
                   "negative": 1, "orphan": 1, "two_current": 1}
    with pytest.raises(dq.QualityGateError) as e:
        dq.gate(res, "test")
    assert e.value.failed == ["empty_table", "null_key", "orphan", "triple_duplicate", "two_current"]
    warn_only = res.filter("severity = 'WARN'")
    assert dq.gate(warn_only) == ["negative"]


def test_null_child_key_counts_as_orphan(spark):
    t = {"c": spark.createDataFrame([(None,), (1,)], "k int"), "p": spark.createDataFrame([(1,)], "k int")}
    res = dq.run_checks(t, [dq.ref_integrity("ri", "c", "k", "p")], "s")
    assert rows(res, "violations") == [(1,)]


def test_expectation_semantics(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", None), (2, "zz", 2000), (None, None, 0)],
                               "id int, status string, q int")
    suite = [ex.values_not_null("id"), ex.values_unique("id"), ex.values_between("q", 1, 1000),
             ex.values_between("q", max_value=1000), ex.values_in_set("status", ["a", "b"]),
             ex.row_count_between(min_value=1), ex.row_count_between(max_value=3)]
    res = ex.run_suite(df, "t", suite)
    got = rows(res, "expectation", "kwargs", "observed", "success")
    assert got == sorted([
        ("expect_column_values_to_not_be_null", '{"column": "id"}', 1, False),
        ("expect_column_values_to_be_unique", '{"column": "id"}', 2, False),      # both members of the pair
        ("expect_column_values_to_be_between", '{"column": "q", "min_value": 1, "max_value": 1000}', 2, False),
        ("expect_column_values_to_be_between", '{"column": "q", "max_value": 1000}', 1, False),
        ("expect_column_values_to_be_in_set", '{"column": "status", "value_set": ["a", "b"]}', 1, False),
        ("expect_table_row_count_to_be_between", '{"min_value": 1}', 4, True),
        ("expect_table_row_count_to_be_between", '{"max_value": 3}', 4, False),
    ], key=repr)
    with pytest.raises(ex.ExpectationsFailed, match="6 expectation"):
        ex.assert_suite(res)
