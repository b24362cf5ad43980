import random
from datetime import datetime, timezone

import pytest

from fleetgauge.functions.payloads import state_key, truck_of_key
from fleetgauge.operators.recovery import recovery_audit
from fleetgauge.operators.normalize import normalize
from fleetgauge.operators.state import (
    changelog_of,
    compact_changelog,
    materialize_changelog,
    reconcile_states,
    running_state,
    state_as_of,
    state_as_of_offsets,
    state_as_of_time,
    state_of,
    truck_totals,
)
from fleetgauge.sources.changelog import decode_changelog

T = "2026-01-01T00:00:{:02d}+00:00"


@pytest.fixture
def changelog(spark):
    def make(*entries):
        data = [(k, v, i) for i, (k, v) in enumerate(entries)]
        return spark.createDataFrame(data, "key string, value struct<sum: double, count: bigint>, seq bigint")

    return make


def test_running_average(readings, rows):
    df = normalize(readings((1, 30.0, T.format(0)), (1, 40.0, T.format(1))))
    assert rows(running_state(df), "sum", "count", "average", order="seq") == [(30.0, 1, 30.0), (70.0, 2, 35.0)]


def test_one_changelog_row_per_reading(readings, rows):
    df = normalize(readings((3, 20.0, T.format(0)), (3, 30.0, T.format(1))))
    log = changelog_of(running_state(df))
    assert rows(log, "key", "value.sum", "value.count", order="seq") == [("truck:3", 20.0, 1), ("truck:3", 50.0, 2)]


@pytest.mark.parametrize("block", [1, 4, 7, 1 << 20])
def test_running_state_does_not_depend_on_the_blocks(readings, rows, block):
    rng = random.Random(5)
    data = [
        (rng.choice([1, 1, 1, 2, 3]), rng.randrange(-500, 9000) / 100, f"2026-01-01T00:{i // 60:02d}:{i % 60:02d}Z")
        for i in range(150)
    ]
    sums, expected = {}, []
    for i, (truck, temperature, _) in enumerate(data):
        if temperature > 0:
            total, count = sums.get(truck, (0, 0))
            sums[truck] = total + round(temperature * 100), count + 1
            expected.append((i, truck, sums[truck][0] / 100, sums[truck][1]))
    found = running_state(normalize(readings(*data)), block=block)
    assert rows(found, "seq", "truck_id", "sum", "count", order="seq") == expected


def test_rebuilt_from_the_changelog(readings, rows):
    df = normalize(readings((1, 30.0, T.format(0)), (1, 36.0, T.format(1)), (2, 41.0, T.format(0))))
    live = materialize_changelog(changelog_of(running_state(df)))
    assert rows(live, "truck_id", "sum", "count", "average", order="truck_id") == [
        (1, 66.0, 2, 33.0), (2, 41.0, 1, 41.0),
    ]
    assert rows(live, order="truck_id") == rows(truck_totals(df), order="truck_id")


def test_replaying_twice_changes_nothing(changelog, rows):
    log = changelog(("truck:1", (30.0, 1)), ("truck:1", (66.0, 2)))
    assert rows(materialize_changelog(log.union(log)), "sum", "count") == [(66.0, 2)]


def test_null_deletes_and_a_later_write_revives(changelog, rows):
    log = changelog(
        ("truck:1", (30.0, 1)), ("truck:2", (5.0, 1)), ("truck:1", None), ("truck:2", None), ("truck:2", (6.0, 2))
    )
    assert rows(materialize_changelog(log), "truck_id", "sum", "count") == [(2, 6.0, 2)]
    compacted = compact_changelog(log)
    assert rows(compacted, "key", "value.sum", "seq", order="key") == [("truck:1", None, 2), ("truck:2", 6.0, 4)]
    assert rows(materialize_changelog(compacted)) == rows(materialize_changelog(log))
    assert rows(state_as_of(log, 1), "truck_id", "sum", order="truck_id") == [(1, 30.0), (2, 5.0)]
    assert rows(state_as_of(log, 2), "truck_id") == [(2,)]


def test_unknown_truck_has_the_empty_state(spark, readings, rows):
    totals = truck_totals(normalize(readings((1, 30.0, T.format(0)))))
    wanted = spark.createDataFrame([(1,), (9,)], "truck_id bigint")
    assert rows(state_of(wanted, totals), order="truck_id") == [(1, 30.0, 1, 30.0), (9, 0.0, 0, 0.0)]


def test_reconciliation(spark, rows):
    schema = "truck_id bigint, sum double, count bigint"
    expected = spark.createDataFrame([(1, 10.0, 1), (2, 20.0, 2), (3, 0.0, 0)], schema)
    recovered = spark.createDataFrame([(1, 10.0, 1), (2, 20.0, 3), (4, 1.0, 1)], schema)
    assert rows(reconcile_states(expected, recovered), "truck_id", "matches", order="truck_id") == [
        (1, True), (2, False), (3, True),
    ]
    both = reconcile_states(expected, recovered, report_extra=True)
    assert rows(both.where("NOT matches"), "truck_id", order="truck_id") == [(2,), (4,)]


def test_recovery_audit(readings, tmp_path):
    batch = [
        (truck, 30.0 + truck + i * 0.1, T.format(i)) for i in range(20) for truck in range(1, 6)
    ]
    row = recovery_audit(normalize(readings(*batch)), f"{tmp_path}/recovery").first()
    assert (row.changelog_records, row.trucks, row.mismatches, row.verdict) == (100, 5, 0, "PASSED")


def test_state_keys_round_trip(spark):
    df = spark.createDataFrame([(11,), (22,)], "id bigint").select(state_key("id").alias("k"), "id")
    assert [(r.k, r.t) for r in df.select("k", truck_of_key("k").alias("t")).collect()] == [
        ("truck:11", 11), ("truck:22", 22),
    ]


def test_state_as_of_over_interleaved_partitions(spark, rows):
    """Two partitions whose messages arrive in turn; positions of one say nothing about the other."""
    log = spark.sql(
        "SELECT 'truck:' || t AS key, to_json(named_struct('sum', double(s), 'count', bigint(n))) AS value, p AS partition, "
        "bigint(o) AS offset, timestamp_seconds(at) AS timestamp FROM VALUES (1, 10, 1, 0, 0, 100), (2, 4, 1, 1, 0, 101), "
        "(1, 21, 2, 0, 1, 102), (2, 9, 2, 1, 1, 103), (3, 7, 1, 1, 2, 104) AS v(t, s, n, p, o, at)"
    )
    log = decode_changelog(log)
    moment = datetime.fromtimestamp(102, timezone.utc)
    assert rows(state_as_of_time(log, moment), "truck_id", "sum", order="truck_id") == [(1, 21.0), (2, 4.0)]
    offsets = spark.createDataFrame([(1, 1)], "partition int, offset bigint")
    assert rows(state_as_of_offsets(log, offsets), "truck_id", "sum") == [(2, 9.0)]
