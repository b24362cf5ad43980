"""Series cut into blocks of rows, wherever the cuts fall, against the forms that cut by time and against plain Python."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from fleetgauge.operators.alerts import AlertRule, sustained_alerts, sustained_alerts_by_blocks
from fleetgauge.operators.rates import counter_rate, counter_rate_by_blocks
from fleetgauge.operators.series import placed, running_sums, runs, with_previous
from fleetgauge.operators.zscore import trailing_zscores, zscore_anomalies

START = datetime(2026, 1, 1, tzinfo=timezone.utc)


@pytest.fixture(params=[1, 7])
def parts(spark, request):
    """So many blocks."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def plain_runs(rows):
    out, since, last = [], None, None
    for key, at, active in sorted(rows):
        if key != last or not active:
            since = None
        if active and since is None:
            since = at
        last = key
        out.append((key, at, since))
    return out


def test_runs_sums_and_predecessors(spark, parts):
    rng = random.Random(parts)
    rows = [("hot", i, rng.random() < 0.97) for i in range(300)] + [(k, i, rng.random() < 0.5) for k in "abz" for i in range(9)]
    rows += [("on", i, True) for i in range(120)]
    df = spark.createDataFrame(rows, "k string, at bigint, active boolean").repartition(3)
    found = runs(df, ("k",), "at", "active").collect()
    assert sorted((r.k, r["at"], r.since) for r in found) == plain_runs(rows)
    found = with_previous(df.withColumn("v", F.col("at") * 2), ("k",), "at", "v").collect()
    assert {(r.k, r["at"]): r.previous for r in found} == {(k, at): None if at == 0 else 2 * at - 2 for k, at, _ in rows}
    total, want = 0, {}
    for k, at, _ in sorted(rows):
        total += at
        want[k, at] = total
    found = running_sums(df.withColumn("v", F.col("at").cast("decimal(38,0)")), ["k", "at"], ["v"]).collect()
    assert {(r.k, r["at"]): int(r.v) for r in found} == want
    if parts > 1:  # the hot series lies in many blocks, none of which is much larger than the others
        sizes = placed(df, ["k", "at"]).groupBy("_part").count().collect()
        assert len(sizes) == parts and max(r["count"] for r in sizes) < 2 * len(rows) / parts


def test_rates_agree_with_spans(spark, parts):
    rng = random.Random(1)
    rows = [("hot", START + timedelta(milliseconds=100 * i), float(rng.randint(0, 50))) for i in range(600)]
    rows += [(k, START + timedelta(seconds=7 * i), rng.choice([1.5, 2.25, 9.0, None, float("nan")])) for k in "abc" for i in range(40)]
    df = spark.createDataFrame(rows, "metric string, ts timestamp, value double").repartition(3)
    key = lambda r: (r.metric, r.ts, r.value, r.rate)
    assert sorted(map(key, counter_rate_by_blocks(df, window=10).collect())) == sorted(map(key, counter_rate(df, window=10).collect()))
    assert counter_rate_by_blocks(df.where("false")).count() == 0


def test_alerts_agree_with_spans(spark, parts):
    rng = random.Random(2)
    rules = [AlertRule("A", "m", ">", 3.0, 20, "warning"), AlertRule("B", "n", "==", 0.0, 5, "info")]
    rows = [(m, START + timedelta(seconds=i * 3), float(rng.randint(0, 9 if m == "m" else 2))) for m in "mn" for i in range(250)]
    rows += [("m", START + timedelta(hours=2, seconds=i), 9.0) for i in range(100)]
    df = spark.createDataFrame(rows, "metric string, ts timestamp, value double").repartition(3)
    by_span, by_block = (sorted(map(str, f(df, rules).collect())) for f in (sustained_alerts, sustained_alerts_by_blocks))
    assert by_span == by_block


def test_trailing_scores_against_plain_python(spark, parts):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2]), rng.randint(900, 1100) if rng.random() < 0.95 else 9000, START + timedelta(seconds=rng.randint(0, 600)), i)
            for i in range(300)] + [(3, 500, START, 900)]
    df = spark.createDataFrame(rows, "truck_id bigint, temperature_centi bigint, event_time timestamp, seq bigint").repartition(3)
    want = {}
    for truck, centi, at, seq in rows:
        near = [c for t, c, a, _ in rows if t == truck and at - timedelta(seconds=60) <= a <= at]
        n, s, q = len(near), sum(near), sum(c * c for c in near)
        spread = n * q - s * s
        if n > 1 and spread and abs(z := (centi * n - s) / spread**0.5) > 2:
            want[seq] = pytest.approx(z, abs=1e-6)
    found = {r.seq: r.zscore for r in trailing_zscores(df, window=60, threshold=2.0).collect()}
    assert found == want and found


def test_a_hot_window_meets_its_statistics_in_many_tasks(spark):
    rows = [(1, 1000 + i % 7 if i else 90_000, START + timedelta(seconds=i), str(i)) for i in range(500)] + [(2, 5, START, "x")]
    df = spark.createDataFrame(rows, "truck_id bigint, temperature_centi bigint, event_time timestamp, timestamp string")
    one = sorted(map(tuple, zscore_anomalies(df, 3600, 3.0).collect()))
    assert sorted(map(tuple, zscore_anomalies(df, 3600, 3.0, block=10).collect())) == one and len(one) == 1
