from conftest import rows, ts

from strata.operators.late import collapse_events, lateness_hours, route_events

E = "event_id string, order_id string, status string, event_time timestamp_ntz, _ingested_at timestamp_ntz"


def test_boundary_is_inclusive_and_whole_seconds(spark):
    et = ts("2024-01-01 00:00:00")
    df = spark.createDataFrame([
        ("a", "o", "x", et, ts("2024-01-02 23:59:59")),         # 47:59:59 → accept
        ("b", "o", "x", et, ts("2024-01-03 00:00:00")),         # 48:00:00 → accept
        ("c", "o", "x", et, ts("2024-01-03 00:00:00.900000")),  # 48:00:00.9 → accept (truncated)
        ("d", "o", "x", et, ts("2024-01-03 00:00:01")),         # 48:00:01 → reject
        ("e", "o", "x", et, ts("2023-12-31 23:00:00")),         # -1 h → accept
    ], E)
    r = route_events(df, 48)
    assert rows(r.accepted, "event_id") == [("a",), ("b",), ("c",), ("e",)]
    assert rows(r.rejected, "event_id") == [("d",)]
    assert rows(lateness_hours(df).filter("event_id = 'e'"), "lateness_hours") == [(-1.0,)]


def test_nulls(spark):
    et = ts("2024-01-01 00:00:00")
    df = spark.createDataFrame([
        ("a", "o", "x", None, ts("2024-01-01 01:00:00")),   # NULL event time → nowhere
        ("b", None, "x", et, ts("2024-01-01 01:00:00")),    # NULL order on time → unroutable only
        ("c", None, "x", et, ts("2024-01-05 00:00:00")),    # NULL order, late → rejected
        (None, "o", "x", et, ts("2024-01-01 01:00:00")),    # NULL key → nowhere
        ("f", "o", "x", et, None),                          # NULL arrival → nowhere
    ], E)
    r = route_events(df, 48)
    assert r.accepted.count() == 0
    assert rows(r.rejected, "event_id") == [("c",)]
    assert rows(r.unroutable, "event_id") == [("b",)]


def test_event_delivered_on_time_and_late_lands_in_both(spark):
    et = ts("2024-01-01 00:00:00")
    df = spark.createDataFrame([
        ("a", "o", "x", et, ts("2024-01-01 01:00:00")),
        ("a", "o", "x", et, ts("2024-01-10 00:00:00")),
        ("a", "o", "y", et, ts("2024-01-01 02:00:00")),  # same route: latest arrival wins
    ], E)
    r = route_events(df, 48)
    assert rows(r.accepted, "event_id", "status") == [("a", "y")]
    assert rows(r.rejected, "event_id") == [("a",)]


def test_collapse_latest_event_wins_even_if_status_regresses(spark):
    df = spark.createDataFrame([
        ("1", "o", "created", ts("2024-01-01 00:00:00"), ts("2024-01-01 00:00:00")),
        ("2", "o", "shipped", ts("2024-01-01 00:05:00"), ts("2024-01-01 00:05:00")),
        ("3", "o", "paid", ts("2024-01-01 00:07:00"), ts("2024-01-01 00:07:00")),  # inverted step
        ("4", "p", "a", ts("2024-01-01 00:00:00"), ts("2024-01-01 00:01:00")),
        ("5", "p", "b", ts("2024-01-01 00:00:00"), ts("2024-01-01 00:02:00")),     # tie → later arrival
    ], E)
    out = collapse_events(df, payload=["status"])
    assert rows(out, "order_id", "status", "first_event_time") == [
        ("o", "paid", ts("2024-01-01 00:00:00")), ("p", "b", ts("2024-01-01 00:00:00"))]
