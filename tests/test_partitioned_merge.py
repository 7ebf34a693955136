import os


from conftest import rows
from strata.operators.merge import Matched, NotMatched
from strata.sinks.partitioned import merge_into_partitions


def _files_mtime(root):
    out = {}
    for d, _, fs in os.walk(root):
        for f in fs:
            if f.endswith(".parquet"):
                out[os.path.join(d, f)] = os.path.getmtime(os.path.join(d, f))
    return out


def test_only_touched_partitions_are_rewritten(spark, tmp_dir):
    path = os.path.join(tmp_dir, "orders")
    S = "id int, v string, b int"
    first = spark.createDataFrame([(i, f"v{i}", i % 4) for i in range(20)], S)
    assert len(merge_into_partitions(path, first, "id", ["b"], [Matched()], [NotMatched()])) == 4
    before = _files_mtime(path)
    src = spark.createDataFrame([(1, "new1", 1), (5, "new5", 1), (101, "ins", 1)], S)
    touched = merge_into_partitions(path, src, "id", ["b"], [Matched()], [NotMatched()])
    assert touched == [(1,)]
    after = _files_mtime(path)
    untouched = [f for f in before if "/b=1/" not in f]
    assert all(f in after and after[f] == before[f] for f in untouched)
    got = spark.read.parquet(path)
    expect = [(i, f"v{i}", i % 4) for i in range(20) if i not in (1, 5)] + [(1, "new1", 1), (5, "new5", 1),
                                                                             (101, "ins", 1)]
    assert rows(got, "id", "v", "b") == sorted(expect, key=repr)


def test_partition_emptied_by_delete_is_removed(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    S = "id int, v string, b int"
    merge_into_partitions(path, spark.createDataFrame([(1, "a", 0), (2, "b", 1)], S), "id", ["b"])
    merge_into_partitions(path, spark.createDataFrame([(2, "x", 1)], S), "id", ["b"],
                          [Matched(delete=True)])
    assert rows(spark.read.parquet(path), "id", "b") == [(1, 0)]
    assert not os.path.exists(os.path.join(path, "b=1"))


def test_insert_only_appends_without_rewriting(spark, tmp_dir):
    from strata.operators.merge import NotMatched
    path = os.path.join(tmp_dir, "events")
    S = "id int, v string, b int"
    merge_into_partitions(path, spark.createDataFrame([(1, "a", 0), (2, "b", 0)], S), "id", ["b"], [], [NotMatched()])
    before = _files_mtime(path)
    merge_into_partitions(path, spark.createDataFrame([(2, "changed", 0), (3, "c", 0)], S), "id", ["b"],
                          [], [NotMatched()])
    after = _files_mtime(path)
    assert all(after.get(f) == m for f, m in before.items())     # old files untouched
    assert len(after) > len(before)                               # new rows appended
    assert rows(spark.read.parquet(path), "id", "v") == [(1, "a"), (2, "b"), (3, "c")]


def test_redelivered_key_in_another_partition_is_no_new_row(spark, tmp_dir):
    path = os.path.join(tmp_dir, "events")
    S = "id int, v string, d string"
    merge_into_partitions(path, spark.createDataFrame([(1, "a", "01"), (2, "b", "02")], S), "id", ["d"], [], [NotMatched()])
    merge_into_partitions(path, spark.createDataFrame([(1, "again", "02"), (3, "c", "02")], S), "id", ["d"], [], [NotMatched()])
    got = spark.read.schema(S).parquet(path)
    assert rows(got, "id", "v", "d") == [(1, "a", "01"), (2, "b", "02"), (3, "c", "02")]


def test_partition_text_is_kept_and_escaped(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    S = "id int, v string, region string"
    merge_into_partitions(path, spark.createDataFrame([(1, "a", "01"), (2, "b", "a:b")], S), "id", ["region"])
    merge_into_partitions(path, spark.createDataFrame([(1, "x", "01"), (2, "y", "a:b")], S), "id", ["region"],
                          [Matched(delete=True)])
    assert not [d for d in os.listdir(path) if d.startswith("region=")]


def test_many_partitions_of_two_columns(spark, tmp_dir):
    path = os.path.join(tmp_dir, "wide")
    df = spark.range(1200).selectExpr("id", "id % 40 as a", "id % 30 as b", "'x' as v").selectExpr(
        "id", "cast(id % 1200 / 30 as int) as a", "cast(id % 30 as int) as b", "v").coalesce(1)
    merge_into_partitions(path, df, "id", ["a", "b"], [Matched()], [NotMatched()])
    merge_into_partitions(path, df.selectExpr("id", "a", "b", "'y' as v"), "id", ["a", "b"], [], [NotMatched()])
    assert spark.read.parquet(path).count() == 1200
