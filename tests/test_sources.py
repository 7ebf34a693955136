import os

from conftest import d, rows, ts
from strata.sources.calendar import dim_date
from strata.sources.files import typed_csv
from strata.sources.json_events import decode_json_events


def test_typed_csv_is_all_string_then_try_cast(spark, tmp_dir):
    path = os.path.join(tmp_dir, "orders.csv")
    with open(path, "w") as f:
        f.write("order_id,customer_id,quantity,unit_price,order_ts\n")
        f.write("ORD-1,7,3,9.5,2024-01-01 10:00:00\n")
        f.write("ORD-2,,n/a,abc,not a date\n")
        f.write("ORD-3,8\n")                       # missing trailing fields → NULL
    df = typed_csv(spark, path, "order_id string, customer_id int, quantity int, unit_price double, "
                                "order_ts timestamp_ntz", as_of="2026-01-01 00:00:00", snapshot="day1")
    assert rows(df, "order_id", "customer_id", "quantity", "unit_price", "order_ts", "snapshot") == [
        ("ORD-1", 7, 3, 9.5, ts("2024-01-01 10:00:00"), "day1"),
        ("ORD-2", None, None, None, None, "day1"),
        ("ORD-3", 8, None, None, None, "day1"),
    ]
    assert rows(df, "_ingested_at")[0] == (ts("2026-01-01 00:00:00"),)


def test_json_cases(spark):
    raw = spark.createDataFrame([
        ('{"event_id": "1", "quantity": 2, "event_time": "2024-01-01 00:00:01"}', 0, 10),  # valid
        ('{"event_id": "2", "quantity": ', 0, 11),                                        # malformed
        ('{"event_id": "3", "quantity": "x"}', 1, 12),                                    # bad field
        ('{"quantity": 1}', 1, 13),                                                       # no id
        (None, 2, 14),                                                                    # NULL value
        ('{"event_id": "6", "event_time": "nope"}', 2, 15),                               # bad time
    ], "value string, partition int, offset bigint")
    out = decode_json_events(raw)
    assert rows(out, "event_id", "quantity", "event_time", "kafka_partition", "kafka_offset") == [
        ("1", 2, ts("2024-01-01 00:00:01"), 0, 10), ("3", None, None, 1, 12), ("6", None, None, 2, 15)]


def test_dim_date_weekend_is_a_parameter(spark):
    df = dim_date(spark, "2026-01-01", "2026-12-31")
    assert df.count() == 365
    assert df.filter("is_weekend").count() == 104           # Friday + Saturday by default
    sat_sun = dim_date(spark, "2026-01-01", "2026-12-31", weekend_days=(1, 7))
    assert rows(sat_sun.filter("full_date = DATE'2026-01-03'"), "day_name", "is_weekend", "date_key") == \
        [("Saturday", True, 20260103)]
    assert rows(df.filter("full_date = DATE'2026-01-02'"), "day_name", "is_weekend") == [("Friday", True)]
    assert d("2026-01-01") == rows(df, "full_date")[0][0]


def test_register_views_for_sql(spark):
    from strata.sources.views import register_views
    names = register_views({"silver.t": spark.range(3)})
    assert names == ["silver_t"]
    assert spark.sql("SELECT count(*) AS n FROM silver_t").collect()[0].n == 3


def test_calendar_covers_the_data_span(spark):
    from strata.sources.calendar import dim_date_covering
    df = spark.createDataFrame([(ts("2024-02-27 10:00:00"),), (ts("2024-03-02 01:00:00"),), (None,)],
                               "order_ts timestamp_ntz")
    cal = dim_date_covering(df, "order_ts")
    assert [r.date_key for r in cal.orderBy("full_date").collect()] == [20240227, 20240228, 20240229, 20240301, 20240302]


def test_layer_profile_counts_every_table(spark):
    from strata.operators.profile import layer_profile, preview
    out = layer_profile({"silver.a": spark.range(3), "gold.b": spark.range(0)})
    assert rows(out) == [("gold", "b", 0), ("silver", "a", 3)]
    assert preview(spark.range(100), 5).count() == 5


def test_csv_columns_are_taken_by_header_name(spark, tmp_dir):
    import pytest

    from strata.sources.files import typed_csv
    p = f"{tmp_dir}/x.csv"
    with open(p, "w") as f:
        f.write("price,extra,id\n9.5,z,1\n")
    r = typed_csv(spark, p, "id bigint, price double").first()
    assert (r.id, r.price) == (1, 9.5)
    with pytest.raises(ValueError, match="no columns"):
        typed_csv(spark, p, "id bigint, name string")


def test_a_broken_off_write_does_not_block_the_table(spark, tmp_dir):
    import os

    from strata.sinks.store import read_latest, write_version
    base = f"{tmp_dir}/t"
    write_version(spark.range(1), base)
    os.makedirs(f"{base}/v=1")
    write_version(spark.range(2), base)
    assert read_latest(spark, base).count() == 2


def test_zoned_times_become_utc(spark):
    from strata.sources.files import apply_schema
    from strata.sources.json_events import decode_json_events
    texts = [("2024-01-01 10:00:00",), ("2024-01-01T10:00:00Z",), ("2024-01-01 10:00:00+05:00",), ("10:00",), ("x",), (None,)]
    want = [ts("2024-01-01 10:00:00"), ts("2024-01-01 10:00:00"), ts("2024-01-01 05:00:00"), None, None, None]
    df = spark.createDataFrame(texts, "t string").coalesce(1)
    assert [r.t for r in apply_schema(df, "t timestamp_ntz").collect()] == want
    events = spark.createDataFrame([('{"event_id": "e", "event_time": "%s"}' % t[0],) for t in texts[:3]], "value string").coalesce(1)
    assert [r.event_time for r in decode_json_events(events).collect()] == want[:3]
