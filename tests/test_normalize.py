from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetgauge.functions.times import iso_utc, parse_event_time
from fleetgauge.operators.normalize import normalize, rejected_readings, temperature_filter
from fleetgauge.operators.state import truck_totals
from fleetgauge.operators.windows import partial_sums

NAN = float("nan")


def test_filter_keeps_what_is_above_zero(readings, rows):
    df = readings(*[(i, t, "2026-01-01") for i, t in enumerate([0.1, 0.0, -5.0, NAN, None, float("inf")])])
    assert rows(temperature_filter(df), "truck_id", order="truck_id") == [(0,), (5,)]


def test_maps_a_valid_reading(readings):
    row = normalize(readings((1, 36.789, "2026-07-18T08:50:45+00:00"))).first()
    assert (row.truck_id, row.temperature_c, row.temperature_centi) == (1, 36.79, 3679)
    assert row.timestamp == "2026-07-18T08:50:45+00:00"


@pytest.mark.parametrize(
    "row",
    [
        (1, 0.0, "2026-07-18T08:50:45+00:00"),
        (1, -1.0, "2026-07-18T08:50:45+00:00"),
        (1, 35.5, "not-a-timestamp"),
        (1, 35.5, None),
        (None, 35.5, "2026-07-18T08:50:45+00:00"),
        (1, NAN, "2026-07-18T08:50:45+00:00"),
        (1, float("inf"), "2026-07-18T08:50:45+00:00"),
        (1, 1e17, "2026-07-18T08:50:45+00:00"),
    ],
)
def test_drops_what_cannot_be_averaged(readings, row):
    assert normalize(readings(row)).count() == 0
    assert rejected_readings(readings(row)).count() == 1


def test_very_large_readings_are_counted_exactly(readings):
    when = "2031-02-03T04:05:06Z"
    df = normalize(readings((4, 1e9, when), (4, 1e15, when), (4, 9e16, when), (4, 9e16, when), (4, 30.25, when)))
    (row,) = partial_sums(df, "truck_id").collect()
    assert row.reading_count == 5
    assert int(row.centi_sum) == 10**11 + 10**17 + 2 * 9 * 10**18 + 3025
    (total,) = truck_totals(df).collect()
    assert total.average == pytest.approx((1e9 + 1e15 + 18e16 + 30.25) / 5)


def test_a_rejected_reading_has_a_reason_and_the_others_are_normalised(readings, rows):
    when = "2031-02-03T04:05:06Z"
    df = readings(
        (None, 5.0, when), (1, None, when), (2, NAN, when), (3, 0.0, when), (4, float("inf"), when), (5, 5.0, "soon"),
        (6, 5.0, when),
    )
    assert rows(rejected_readings(df), "seq", "reason", order="seq") == [
        (0, "no truck"),
        (1, "no temperature"),
        (2, "temperature is not a number"),
        (3, "temperature not above zero"),
        (4, "temperature too large to add up"),
        (5, "timestamp unreadable"),
    ]
    assert rows(normalize(df), "truck_id") == [(6,)]


TEXTS = [
    "2026-07-18T08:50:45",
    "2026-07-18T08:50:45Z",
    "2026-07-18T08:50:45+00:00",
    "2026-07-18 08:50:45.987061+05:30",
    "2026-07-18T08:50:45.5-0700",
    "2026-07-18T08:50:45+02",
    "2026-07-18",
    "2026-07-18T08",
    "2026-07-18T08Z",
    "2026-07-18T08:50",
    "2026-07-18T08:50+01:00",
    "2026-07-18T08:50:45,123",
    "2026-07-18T08:50:45.123456789",
    "2026",
    "2026-07",
    "12:30",
    "2026-7-8",
    " 2026-07-18",
    "2026-07-18T08:50:45 ",
    "2026-07-18\n",
    "2026-02-30",
    "2026-13-01",
    "2026-07-18T25:00:00",
    "2026-07-18T08:61:00",
    "2026-07-18T08:50:45 UTC",
    "18/07/2026",
    "not-a-timestamp",
    "",
]


def python_instant(text):
    try:
        parsed = datetime.fromisoformat(text)
    except ValueError:
        return None
    return parsed if parsed.tzinfo else parsed.replace(tzinfo=timezone.utc)


def spark_instants(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = df.select("i", F.unix_micros(parse_event_time("t")).alias("us")).orderBy("i").collect()
    return [
        None if r.us is None else datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=r.us)
        for r in found
    ]


def test_parses_what_python_parses(spark):
    assert dict(zip(TEXTS, spark_instants(spark, TEXTS))) == {t: python_instant(t) for t in TEXTS}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.datetimes(datetime(1900, 1, 1), datetime(2200, 1, 1)),
            st.sampled_from(["", "Z", "+00:00", "-05:30", "+14:00"]),
            st.sampled_from(["T", " "]),
            st.sampled_from(["auto", "minutes", "seconds", "milliseconds", "microseconds"]),
        ),
        min_size=20,
        max_size=60,
    )
)
def test_parses_any_iso_text(spark, cases):
    texts = [when.isoformat(sep, spec) + zone for when, zone, sep, spec in cases]
    assert spark_instants(spark, texts) == [python_instant(t) for t in texts]


def test_writes_instants_as_utc_text(spark):
    df = spark.sql("SELECT timestamp_micros(1784364645000000) AS a, timestamp_micros(1784364645987061) AS b")
    assert tuple(df.select(iso_utc("a"), iso_utc("b")).first()) == (
        "2026-07-18T08:50:45+00:00",
        "2026-07-18T08:50:45.987061+00:00",
    )
