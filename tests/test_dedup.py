from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fleetgauge.operators.dedup import accepted_readings, dedup_readings, split_stages
from fleetgauge.operators.normalize import normalize


def test_repeated_key_is_dropped(readings, rows):
    df = readings((1, 1.0, "t1"), (1, 2.0, "t1"), (2, 3.0, "t1"), (1, 4.0, "t2"))
    assert rows(dedup_readings(df), "truck_id", "temperature", order="seq") == [(1, 1.0), (2, 3.0), (1, 4.0)]


def test_first_arrival_wins_even_when_it_is_filtered_later(readings):
    t = "2026-01-01T00:00:00+00:00"
    assert normalize(dedup_readings(readings((1, -1.0, t), (1, 30.0, t)))).count() == 0


def test_null_values_of_the_first_arrival_stay(readings, rows):
    df = readings((1, None, "t", None, 1.0, None), (1, 5.0, "t", 2.0, None, 3.0))
    assert rows(dedup_readings(df), "temperature", "fuel_level", "latitude") == [(None, None, 1.0)]


def test_key_is_the_text_of_the_timestamp(readings):
    df = readings((1, 1.0, "2026-01-01T00:00:00Z"), (1, 1.0, "2026-01-01T00:00:00+00:00"))
    assert dedup_readings(df).count() == 2


def test_rows_without_a_key_are_dropped(readings):
    assert dedup_readings(readings((None, 1.0, "t"), (1, 1.0, None))).count() == 0


def test_stages(readings, rows):
    df = readings(
        (None, 1.0, "t"), (1, 1.0, None), (1, -1.0, "a"), (1, 9.0, "a"), (1, None, "b"), (1, 5.0, "c"),
        (1, float("nan"), "d"), (1, 0.0, "e"),
    )
    assert rows(split_stages(df), "stage", order="seq") == [
        ("no_key",), ("no_key",), ("filtered",), ("duplicate",), ("accepted",), ("accepted",), ("accepted",),
        ("filtered",),
    ]


def brute_force_stages(rows):
    seen, out = set(), []
    for truck, temperature, timestamp in rows:
        if truck is None or timestamp is None:
            out.append("no_key")
        elif (truck, timestamp) in seen:
            out.append("duplicate")
        else:
            seen.add((truck, timestamp))
            out.append("filtered" if temperature is not None and temperature <= 0 else "accepted")
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.sampled_from([None, 1, 1, 1, 2, 3]),
            st.sampled_from([None, -1.0, 0.0, 1.5, 43.0]),
            st.sampled_from([None, "a", "a", "b", "c"]),
        ),
        min_size=1,
        max_size=60,
    )
)
def test_stages_match_a_loop(readings, rows, data):
    df = readings(*data)
    expected = brute_force_stages(data)
    assert [s for (s,) in rows(split_stages(df), "stage", order="seq")] == expected
    kept = [i for i, stage in enumerate(expected) if stage == "accepted"]
    assert [s for (s,) in rows(accepted_readings(df), "seq", order="seq")] == kept


def test_hot_key_is_reduced_before_the_exchange(spark, readings):
    """Plan: the filter stays above the aggregate, and a partial aggregate stands below the exchange."""
    df = normalize(dedup_readings(readings((1, 1.0, "2026-01-01"))))
    plan = df._jdf.queryExecution().executedPlan().toString()
    operators = [line.strip(" :+-*()0123456789") for line in plan.splitlines()]
    kinds = [o.split(" ")[0].split("(")[0] for o in operators if o]
    order = [k for k in kinds if k in ("Filter", "HashAggregate", "ObjectHashAggregate", "Exchange", "Sort", "Window")]
    assert order[:4] == ["Filter", "HashAggregate", "Exchange", "HashAggregate"], plan
    assert Counter(order)["Exchange"] == 1, plan


@pytest.mark.parametrize("copies", [500])
def test_many_copies_of_one_reading(readings, copies):
    df = readings(*[(1, float(i), "t") for i in range(copies)], (2, 1.0, "t"))
    assert sorted(r.temperature for r in dedup_readings(df).collect()) == [0.0, 1.0]
