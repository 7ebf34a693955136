from conftest import rows, ts

from strata.operators.keyed import latest_by, snapshot_replace

SCHEMA = "k string, v int, t timestamp_ntz, tb int"


def test_latest_by_picks_first_in_order_with_tiebreak(spark):
    df = spark.createDataFrame([
        ("a", 1, ts("2024-01-01 00:00:00"), 2),
        ("a", 2, ts("2024-01-02 00:00:00"), 9),
        ("a", 3, ts("2024-01-02 00:00:00"), 1),  # ties on t: tiebreak tb ASC decides
        ("b", 4, None, 1),                      # NULL sorts last under DESC
        ("b", 5, ts("2020-01-01 00:00:00"), 1),
    ], SCHEMA)
    out = latest_by(df, "k", ["t DESC"], tiebreak=["tb"])
    assert rows(out, "k", "v") == [("a", 3), ("b", 5)]


def test_dirty_newest_row_does_not_hide_clean_older_row(spark):
    df = spark.createDataFrame([
        ("a", -1, ts("2024-01-02 00:00:00"), 1),  # newest but dirty
        ("a", 7, ts("2024-01-01 00:00:00"), 1),
    ], SCHEMA)
    clean = df.filter("v > 0")
    assert rows(latest_by(clean, "k", ["t DESC"]), "v") == [(7,)]


def test_latest_by_uses_partial_window_group_limit(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    plan = latest_by(df, "k", ["v DESC"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_snapshot_replace_is_null_safe(spark):
    target = spark.createDataFrame([(1, "day1"), (2, "day2"), (3, None)], "id int, snapshot string")
    new = spark.createDataFrame([(4, "x")], "id int, snapshot string")
    out = snapshot_replace(target, new, "snapshot", "day2")
    assert rows(out) == [(1, "day1"), (3, None), (4, "day2")]


def test_survivor_does_not_depend_on_arrival_order(spark):
    data = [(1, 5, "b"), (1, 5, "a"), (1, 5, None), (2, 1, "z"), (1, 4, "c")]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "k int, loaded int, name string").coalesce(1)
        assert sorted(map(tuple, latest_by(df, "k", ["loaded DESC"]).collect())) == [(1, 5, None), (2, 1, "z")]
