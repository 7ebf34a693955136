"""Checks counted in the write of a table, against the same checks by a scan."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from strata.operators import expectations as ex
from strata.operators import quality as dq
from strata.operators.observed import Watch
from strata.plans import medallion as M
from strata.sinks import store

CHECKS = [dq.not_empty("some", "t"), dq.null_keys("keys", "t", ["k"]), dq.predicate("negative", "t", "v < 0"), dq.duplicates("twice", "t", "k")]
SUITE = [ex.values_not_null("k"), ex.values_unique("k"), ex.values_between("v", min_value=0, max_value=50), ex.values_in_set("p", ["a"]),
         ex.row_count_between(min_value=1)]


def table(spark, n=1000):
    return spark.range(n).repartition(7).selectExpr("if(id % 10 = 0, null, id) as k", "if(id % 7 = 0, null, id % 103 - 3) as v", "if(id % 3 = 0, 'a', 'b') as p")


@pytest.mark.parametrize("n, partition_by, part", [(1000, None, None), (1000, ["p"], None), (1000, ["p"], "a"), (0, None, None), (0, ["p"], "a")])
def test_counts_of_the_write_equal_a_scan(spark, n, partition_by, part):
    df = table(spark, n)
    among = None if part is None else F.col("p") == part
    watch = Watch(dq.row_counts(CHECKS, among) | ex.row_counts(SUITE, among))
    out = store.materialize(df, "observed", partition_by, watch)
    assert out.count() == n
    if part:
        out = out.where(among)
    fixed = F.lit("now")
    scan = dq.run_checks({"t": out}, CHECKS, "s", fixed).where("check_name <> 'twice'")
    seen = dq.observed_results(spark, watch.get(), CHECKS, "s", fixed)
    assert seen.columns == scan.columns and rows(seen) == rows(scan)
    scan = ex.run_suite(out, "t", SUITE, fixed).where("expectation not like '%unique%'")
    seen = ex.observed_results(spark, watch.get(), "t", SUITE, fixed)
    assert seen.columns == scan.columns and rows(seen) == rows(scan)
    assert "FileScan" not in seen._jdf.queryExecution().toString()


def test_refused_version_is_never_read(spark, tmp_dir):
    def judge(counts):
        dq.gate(dq.observed_results(spark, counts, CHECKS, "s"))

    def write(df):
        return store.write_version(df, tmp_dir, watch=Watch(dq.row_counts(CHECKS)), judge=judge)

    good = table(spark).where("k is not null and coalesce(v, 0) >= 0")
    write(good)
    with pytest.raises(dq.QualityGateError) as e:
        write(table(spark))
    assert e.value.failed == ["keys", "negative"]
    assert store.read_latest(spark, tmp_dir).count() == good.count()
    write(good.where("k > 500"))                  # a later run commits its own version
    assert store.read_latest(spark, tmp_dir).agg(F.min("k")).first()[0] > 500
    assert store.expire(spark, tmp_dir, keep=1, older_than_seconds=0) == [f"{tmp_dir}/v=0", f"{tmp_dir}/v=1"]


def test_layers_count_in_their_writes(spark):
    layers = M.build_layers(spark, "/root/testdata/sf0.001", observe=True)
    seen = M.observed_checks(layers)
    assert "FileScan" not in seen._jdf.queryExecution().toString()
    scan = M.run_stage_checks(layers, kinds=set(dq.ROW_KINDS))
    assert rows(seen) == rows(scan) and len(rows(seen)) == sum(c.kind in dq.ROW_KINDS for cs in M.checks().values() for c in cs)
