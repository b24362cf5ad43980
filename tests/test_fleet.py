from datetime import datetime

import pytest

from pyspark.sql import functions as F

from fleetgauge.operators.dedup import accepted_readings
from fleetgauge.operators.fleet import (
    anomalies,
    fleet_latest,
    fleet_positions,
    fleet_roster,
    latest_averages,
    recent_anomalies,
    recent_readings,
    roster_page,
)

NAN = float("nan")


@pytest.fixture
def averages(spark):
    def make(*entries):
        data = [(*e, datetime(2026, 1, 1, 12, i), i) for i, e in enumerate(entries)]
        return spark.createDataFrame(
            data,
            "truck_id bigint, window_type string, average_temperature double, reading_count bigint, "
            "computed_at timestamp, seq bigint",
        )

    return make


def test_latest_keeps_null_temperature_and_last_known_rest(readings, rows):
    df = readings((1, 30.0, "a", 50.0, 1.0, None), (1, None, "b", None, None, 2.0), (2, 5.0, "a"))
    assert rows(fleet_latest(df), order="truck_id") == [
        (1, None, "b", 50.0, 1.0, 2.0, "active"), (2, 5.0, "a", None, None, None, "active"),
    ]


def test_latest_averages_count_both_kinds(averages, rows):
    df = averages((1, "hopping", 30.0, 2), (1, "tumbling", 31.0, 3), (1, "hopping", 32.0, None), (None, "hopping", 1.0, 1))
    found = latest_averages(df).select("truck_id", "tumbling_avg", "hopping_avg", "reading_count", "tumbling_count")
    assert rows(found) == [(1, 31.0, 32.0, 5, 3)]


def test_roster_precedence(readings, averages, rows):
    accepted = readings((1, 30.0, "a"), (2, None, "b"))
    found = fleet_roster(accepted, averages((2, "tumbling", 9.0, 4), (3, "hopping", 7.0, 2), (3, "hopping", 8.0, 2)))
    columns = ("truck_id", "last_temperature", "last_timestamp", "tumbling_avg", "hopping_avg", "reading_count")
    assert rows(found, *columns, order="truck_id") == [
        (1, 30.0, "a", None, None, 0),
        (2, None, "b", 9.0, None, 4),
        (3, 7.0, "2026-01-01T12:01:00+00:00", None, 8.0, 4),
    ]


def test_roster_page_is_sorted_and_limited(readings, averages, rows):
    roster = fleet_roster(readings(*[(i, 1.0, "a") for i in range(30, 0, -1)]), averages())
    assert rows(roster_page(roster, 3), "truck_id") == [(1,), (2,), (3,)]


def test_anomaly_thresholds(readings, rows):
    df = readings(*[(i, t, "a") for i, t in enumerate([42.0, 42.1, 45.0, 45.1, NAN, None])])
    assert rows(anomalies(df), "truck_id", "severity", order="truck_id") == [
        (1, "warning"), (2, "warning"), (3, "critical"),
    ]


def test_recent_lists_are_newest_first(readings, rows):
    df = readings(*[(i, 50.0 if i % 2 else 20.0, "a") for i in range(120)])
    assert rows(recent_anomalies(df), "truck_id") == [(i,) for i in range(119, 89, -2)]
    assert rows(recent_readings(accepted_readings(df)), "truck_id") == [(i,) for i in range(119, 99, -1)]
    assert recent_anomalies(df, rows=500).count() == 60


def test_recent_lists_follow_arrival_over_partitions(readings, rows):
    """Two partitions of a log take turns; numbers of the second are all larger than those of the first."""
    df = readings(*[(i, 50.0, "a") for i in range(8)])
    df = df.withColumns({"arrival": F.timestamp_seconds("seq"), "seq": F.expr("(seq % 2) * 8589934592 + seq div 2")})
    assert rows(recent_readings(df, 3), "truck_id") == [(7,), (6,), (5,)]
    assert rows(recent_anomalies(df, 3), "truck_id") == [(7,), (6,), (5,)]


def test_recent_lists_need_no_global_sort(readings):
    plan = recent_readings(readings((1, 1.0, "a")))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_positions(readings, averages, rows):
    accepted = readings((1, 43.0, "a", None, 1.0, 2.0), (2, 42.0, "a", None, 1.0, None), (3, NAN, "a"))
    found = fleet_positions(fleet_roster(accepted, averages()))
    columns = ("truck_id", "map_latitude", "map_longitude", "gps_source", "is_anomalous")
    assert rows(found, *columns, order="truck_id") == [
        (1, 1.0, 2.0, "kafka", True), (2, None, None, "simulated", False), (3, None, None, "simulated", False),
    ]
