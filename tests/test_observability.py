import itertools
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetgauge.operators.alerts import AlertRule, current_alerts, sustained_alerts
from fleetgauge.operators.audits import average_audit, exactly_once_audit, throughput_audit
from fleetgauge.operators.dedup import dedup_readings
from fleetgauge.operators.normalize import normalize, with_event_time
from fleetgauge.operators.quality import consumer_lag, dataset_quality, telemetry_totals
from fleetgauge.operators.rates import counter_rate, parsed_rate, stage_rates, throughput_history
from fleetgauge.operators.windows import window_averages
from fleetgauge.operators.zscore import zscore_anomalies

START = datetime(2026, 1, 1)


@pytest.fixture
def samples(spark):
    def make(*entries):
        data = [(m, START + timedelta(seconds=s), v) for m, s, v in entries]
        return spark.createDataFrame(data, "metric string, ts timestamp, value double")

    return make


def seconds(row):
    return (row.ts - START).total_seconds()


@pytest.mark.parametrize("span", [60, 90, 3600])
def test_counter_rate_matches_a_loop(samples, span):
    rng = random.Random(span)
    moments = sorted(rng.sample(range(0, 2000), 150))
    # Quiet for a while in the middle, so that some spans have no sample.
    series = [(m if m < 1000 else m + 700, float(rng.choice([0, 1, 5, i, 3 * i]))) for i, m in enumerate(moments)]
    increases, previous, expected = [], None, {}
    for moment, value in series:
        increases.append(0.0 if previous is None else value - previous if value >= previous else value)
        previous = value
        expected[moment] = (
            sum(inc for (m, _), inc in zip(series, increases) if moment - 60 <= m <= moment) / 60
        )
    df = samples(*[("a", m, v) for m, v in series], *[("b", m, 1.0) for m, _ in series[:5]])
    found = counter_rate(df, window=60, span=span).collect()
    assert {seconds(r): r.rate for r in found if r.metric == "a"} == pytest.approx(expected)
    assert [r.rate for r in found if r.metric == "b"] == [0.0] * 5


def test_counter_rate_passes_over_samples_without_a_value(samples):
    df = samples(("a", 0, 10.0), ("a", 10, float("nan")), ("a", 20, None), ("a", 30, 16.0), ("a", 1200, 28.0))
    found = counter_rate(df, window=60).orderBy("ts").collect()
    assert [(seconds(r), r.rate) for r in found] == [(0, 0.0), (30, 0.1), (1200, 0.2)]


def test_counter_rate_forgets_a_huge_increase(samples):
    df = samples(("a", 0, 0.0), ("a", 10, 1e17), ("a", 100, 3.0), ("a", 200, 10.0))
    assert [r.rate for r in counter_rate(df, window=60).orderBy("ts").collect()] == [0.0, 1e17 / 60, 3 / 60, 7 / 60]


@pytest.mark.parametrize("span", [10, 37, 3600])
def test_alerts_match_a_loop(samples, span):
    rng = random.Random(span)
    rules = [AlertRule("low", "g", "==", 0.0, 25, "warning"), AlertRule("high", "g", ">", 1.0, 40, "info")]
    moments = sorted(rng.sample(range(0, 600), 120))
    series, level = [], 0.0
    for m in moments:
        if rng.random() < 0.15:
            level = float(rng.choice([0, 1, 2]))
        series.append((m, level))
    expected = {}
    for rule in rules:
        since = None
        for m, v in series:
            active = v == 0 if rule.comparison == "==" else v > 1
            since = (m if since is None else since) if active else None
            state = "inactive" if since is None else "firing" if m - since >= rule.hold else "pending"
            expected[rule.alert, m] = (since, state)
    df = samples(*[("g", m, v) for m, v in series], ("other", 1, 0.0))
    states = sustained_alerts(df, rules, span=span)
    got = {
        (r.alert, seconds(r)): (r.active_since and (r.active_since - START).total_seconds(), r.state)
        for r in states.collect()
    }
    assert got == expected
    last = moments[-1]
    assert {r.alert: r.state for r in current_alerts(states).collect()} == {
        rule.alert: expected[rule.alert, last][1] for rule in rules
    }


def test_nan_satisfies_no_threshold(samples):
    rule = AlertRule("high", "g", ">", 20.0, 0, "info")
    found = sustained_alerts(samples(("g", 0, float("nan")), ("g", 1, 21.0)), [rule]).orderBy("ts").collect()
    assert [r.state for r in found] == ["inactive", "firing"]


def test_consumer_lag(spark, rows):
    schema = "topic string, partition int, high bigint, committed bigint"
    offsets = spark.createDataFrame(
        [("a", 0, 10, 4), ("a", 1, 10, -1001), ("b", 0, 5, 7), ("b", 1, 5, None)], schema
    )
    assert sorted(rows(consumer_lag(offsets)), key=str) == [("a", 6, None), ("b", 0, None), (None, 6, "ok")]
    idle = offsets.where("topic = 'b'")
    assert sorted(rows(consumer_lag(idle, group_known=False)), key=str) == [("b", 0, None), (None, None, "down")]
    assert (None, 6, "ok") in rows(consumer_lag(offsets, group_known=False))


def test_dataset_quality(spark):
    schema = "truck_id string, temperature double, timestamp string"
    bad = spark.createDataFrame([("a", 1.0, "t"), ("a", -1.0, "t"), ("b", None, "t"), (None, 2.0, "t")], schema)
    row = dataset_quality(bad).first()
    assert (row["rows"], row.unique_trucks, row.null_truck_id, row.null_temperature) == (4, 2, 1, 1)
    assert (row.not_positive, row.valid, row.valid_reported, row.verdict) == (2, 2, 1, "FAIL")
    assert dataset_quality(bad.where("truck_id = 'a'")).first().verdict == "PASS"
    lacking = dataset_quality(bad.drop("timestamp")).first()
    assert (lacking.verdict, lacking.reason) == ("FAIL", "missing columns ['timestamp']")


@pytest.fixture
def arrivals(readings):
    def make(*entries):
        df = readings(*[e[1:] for e in entries])
        offsets = F.element_at(F.array(*[F.lit(float(e[0])) for e in entries]), (F.col("seq") + 1).cast("int"))
        return df.withColumn("arrival", F.timestamp_micros((offsets * 1_000_000).cast("bigint")))

    return make


def test_stage_rates(arrivals):
    df = arrivals((0.5, 1, 30.0, "a"), (0.6, 1, 30.0, "a"), (1.5, 1, -1.0, "b"), (2.5, 1, None, "c"), (3.0, None, 1.0, "d"))
    rates = parsed_rate(stage_rates(df)).withColumn("s", F.unix_seconds("sampled_at")).orderBy("s").collect()
    assert [r.s for r in rates] == list(range(1, 8))
    by_second = {r.s: (r.ingestion_rate, r.filter_rate, r.duplicate_rate, r.parsed_rate) for r in rates}
    assert by_second[1] == (0.2, 0.0, 0.2, 0.2)
    assert by_second[3] == (0.4, 0.2, 0.2, 0.2)
    assert by_second[6] == (0.2, 0.2, 0.0, 0.0)
    assert [r.ingestion for r in throughput_history(stage_rates(df), 2).collect()] == [0.2, 0.2]


def test_throughput_history_shows_idle_seconds(arrivals):
    df = arrivals((0.5, 1, 30.0, "a"), (20.5, 1, 30.0, "b"))
    found = throughput_history(stage_rates(df), 10).withColumn("s", F.unix_seconds("sampled_at")).collect()
    assert [(r.s, r.ingestion) for r in found] == [(s, 0.2 if s > 20 else 0.0) for s in range(25, 15, -1)]
    assert throughput_history(stage_rates(df.limit(0)), 10).count() == 0


def test_totals(readings, spark):
    df = readings(
        (None, 1.0, "a"), (1, 50.0, "a"), (1, 50.0, "a"), (1, -1.0, "b"), (2, -1.0, "a"), (3, None, "a"), (3, 1.0, None)
    )
    averages = spark.sql("SELECT * FROM VALUES (1L), (4L), (4L) AS t(truck_id)")
    row = telemetry_totals(df, averages).first()
    assert row.asDict() == {
        "total_raw": 7, "no_key": 2, "duplicates": 1, "filtered": 2, "accepted": 2, "total_aggregates": 3,
        "active_trucks": 3, "anomalies_seen": 1, "anomalies": 1,
    }
    assert telemetry_totals(df.limit(0)).first().total_raw == 0


BASE = datetime(2026, 1, 1, 12)


def batch(trucks=3, per_truck=6):
    return [
        (truck, 30.0 + truck + i * 0.5, (BASE + timedelta(milliseconds=100 * i)).isoformat() + "+00:00")
        for i in range(per_truck)
        for truck in range(1, trucks + 1)
    ]


def test_exactly_once_audit(readings):
    ahead = (BASE + timedelta(minutes=20)).isoformat() + "+00:00"
    sent = with_event_time(readings(*batch(), *batch(), *[(t, 25.0, ahead) for t in (1, 2, 3)]))
    real = sent.where(F.col("timestamp") != ahead)
    cutoff = BASE + timedelta(minutes=2)
    once = exactly_once_audit(window_averages(normalize(dedup_readings(sent))), real, cutoff).first()
    assert (once.counted, once.distinct_sent, once.total_sent, once.verdict) == (18, 18, 36, "PASSED")
    twice = exactly_once_audit(window_averages(normalize(sent)), real, cutoff).first()
    assert (twice.counted, twice.verdict) == (36, "FAILED")
    none = exactly_once_audit(window_averages(normalize(sent)).limit(0), real, cutoff).first()
    assert (none.counted, none.verdict) == (0, "INCONCLUSIVE")


def test_average_audit_finds_a_wrong_average(readings):
    rows = normalize(readings(*batch()))
    averages = window_averages(rows)
    assert all(r.missing == r.unexpected == r.different == 0 for r in average_audit(averages, rows).collect())
    wrong = averages.withColumn(
        "average_temperature",
        F.when(F.col("truck_id") == 1, F.col("average_temperature") + 0.0001).otherwise(F.col("average_temperature")),
    ).where("truck_id != 2")
    found = {r.window_type: (r.windows, r.missing, r.different) for r in average_audit(wrong, rows).collect()}
    assert found == {"tumbling": (3, 1, 1), "hopping": (15, 5, 5)}


def test_throughput_audit(arrivals):
    df = arrivals((0.0, 1, 1.0, "a"), (0.5, 1, 1.0, "b"), (2.0, 1, 1.0, "c"))
    row = throughput_audit(df).first()
    assert (row.events, row.elapsed_seconds, row.events_per_second, row.verdict) == (3, 2.0, 1.5, "BELOW TARGET")
    assert throughput_audit(df, target=1.5).first().verdict == "PASS"
    assert throughput_audit(df.limit(1)).first().verdict == "BELOW TARGET"


def test_zscore(readings):
    usual = [(1, 30.0 + (i % 3), f"2026-01-01T00:00:{i:02d}") for i in range(30)]
    found = zscore_anomalies(normalize(readings(*usual, (1, 90.0, "2026-01-01T00:01:00"), (2, 99.0, "2026-01-01"))))
    (row,) = found.collect()
    assert row.temperature_c == 90.0 and row.zscore > 5


def test_counter_rate_costs_the_same_however_many_samples_a_window_covers(samples):
    """No sample goes through the samples of its window again, and the sums are those of a loop: both ends, restarts,
    stretches without samples and instants before 1970 included."""
    rng = random.Random(21)
    at = sorted(rng.sample(range(-400, 3000), 700))
    values = [float(rng.randint(0, 50)) for _ in at]
    rows = [("m", t, v) for t, v in zip(at, values, strict=True)]
    df = samples(*rows)
    increase = [0.0] + [v - u if v >= u else v for u, v in itertools.pairwise(values)]
    for span in (10, 70):
        found = counter_rate(df, window=10, span=span)
        plan = found._jdf.queryExecution().optimizedPlan().toString().lower()
        assert "rowframe" in plan and "rangeframe, -" not in plan
        expected = [sum(d for s, d in zip(at, increase, strict=True) if t - 10 <= s <= t) / 10 for t in at]
        assert [r.rate for r in found.orderBy("ts").collect()] == expected
