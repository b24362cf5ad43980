import random
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fleetgauge.config import DEFAULT_WINDOWS, DEMO_WINDOWS, WindowConfig
from fleetgauge.functions import numbers
from fleetgauge.functions.numbers import average_of, from_centi
from fleetgauge.operators.normalize import normalize
from fleetgauge.operators.windows import (
    build_window_average,
    expected_average,
    hopping_average,
    merge_partials,
    pane_sums,
    partial_sums,
    roll_up,
    tumbling_average,
    window_averages,
    window_bounds_iso,
)

START = datetime(2026, 1, 1, tzinfo=timezone.utc)


def at(seconds):
    return (START + timedelta(seconds=seconds)).isoformat()


def test_window_mean(readings, rows):
    df = normalize(readings((1, 30.0, at(0)), (1, 40.0, at(10))))
    found = rows(tumbling_average(df), "truck_id", "reading_count", "average_temperature")
    assert found == [(1, 2, 35.0)]


def test_windows_are_half_open(readings, rows):
    df = normalize(readings((1, 30.0, at(299.999999)), (1, 40.0, at(300))))
    assert rows(tumbling_average(df), "average_temperature", order="window_start") == [(30.0,), (40.0,)]


def test_reading_counts_once_in_each_hop_that_covers_it(readings, rows):
    found = window_bounds_iso(hopping_average(normalize(readings((1, 30.0, at(301))))))
    starts = [s for (s,) in rows(found, "window_start", order="window_start")]
    assert starts == [at(60 * k) for k in range(1, 6)]


def test_merged_partials(spark, rows):
    df = spark.createDataFrame(
        [(1, 5000, 2), (1, 3000, 1), (2, None, None)], "truck_id bigint, centi_sum bigint, reading_count bigint"
    )
    merged = merge_partials(df, "truck_id").withColumn("average", average_of("centi_sum", "reading_count"))
    assert rows(merged, "truck_id", "reading_count", "average", order="truck_id") == [(1, 3, 26.6667), (2, 0, 0.0)]


def test_empty_window_gives_no_row_and_payload_is_complete(spark):
    sums = spark.sql(
        "SELECT 7L AS truck_id, struct(timestamp_seconds(1700000000) AS start, timestamp_seconds(1700000300) AS "
        "end) AS window, c * 3500 AS centi_sum, c AS reading_count FROM VALUES (0L), (3L) AS t(c)"
    )
    built = build_window_average(sums, "hopping", datetime(2026, 1, 1, 12, 0, tzinfo=timezone.utc))
    (row,) = window_bounds_iso(built).collect()
    assert (row.truck_id, row.window_type, row.average_temperature, row.reading_count) == (7, "hopping", 35.0, 3)
    assert row.window_start == "2023-11-14T22:13:20+00:00" and row.window_end == "2023-11-14T22:18:20+00:00"
    assert row.computed_at == "2026-01-01T12:00:00+00:00"


@pytest.mark.parametrize(
    "config", [DEFAULT_WINDOWS, DEMO_WINDOWS, WindowConfig(300, 300), WindowConfig(300, 70), WindowConfig(420, 60)]
)
def test_both_kinds_match_a_loop(readings, rows, config):
    rng = random.Random(config.size + config.step)
    data = [
        (rng.choice([1, 1, 1, 2]), round(rng.uniform(0.01, 90), 2), at(rng.randrange(0, 4000) + rng.random()))
        for _ in range(200)
    ]
    expected = {}
    for truck, temperature, text in data:
        moment = datetime.fromisoformat(text).timestamp()
        first_hop = int(moment // config.step) * config.step
        starts = [("tumbling", int(moment // config.size) * config.size)]
        starts += [
            ("hopping", first_hop - k * config.step)
            for k in range(config.size // config.step + 1)
            if first_hop - k * config.step + config.size > moment
        ]
        for kind, start in starts:
            expected.setdefault((truck, kind, start), []).append(round(temperature * 100))
    found = window_averages(normalize(readings(*data)), config)
    got = {
        (r.truck_id, r.window_type, int(r.window_start.replace(tzinfo=timezone.utc).timestamp())): (
            r.reading_count, r.average_temperature
        )
        for r in found.collect()
    }
    assert got.keys() == expected.keys()
    for key, cents in expected.items():
        n = len(cents)
        assert got[key] == (n, ((200 * sum(cents) + n) // (2 * n)) / 10000)


def test_rolled_up_panes_equal_direct_sums(readings, rows):
    rng = random.Random(3)
    df = normalize(readings(*[(1, rng.randrange(1, 9000) / 100, at(rng.randrange(9000))) for _ in range(100)]))
    columns = ("window.start", "centi_sum", "reading_count")
    direct = rows(pane_sums(df, 900), *columns, order="window.start")
    assert rows(roll_up(pane_sums(df, 300), 900), *columns, order="window.start") == direct


def test_sums_are_exact(readings):
    df = normalize(readings(*[(1, 0.1, at(i)) for i in range(1000)]))
    (row,) = partial_sums(df, "truck_id").select(from_centi("centi_sum").alias("s")).collect()
    assert row.s == 100.0


def test_a_hop_longer_than_the_window_is_refused():
    with pytest.raises(ValueError):
        WindowConfig(60, 300)


def test_expected_average(spark):
    series = spark.createDataFrame([(32.0,), (34.0,), (36.0,)], "v double")
    assert expected_average(series, "v").first()[0] == 34.0
    with pytest.raises(PySparkException, match="empty series"):
        expected_average(series.where("v < 0"), "v").collect()


def test_average_rounds_half_away_from_zero(spark):
    df = spark.sql("SELECT * FROM VALUES (1L, 8L), (-1L, 8L), (8000L, 3L), (0L, 0L), (9000000000000000000L, 1000000L) AS t(s, n)")
    assert [r[0] for r in df.select(average_of("s", "n")).collect()] == [0.0013, -0.0013, 26.6667, 0.0, 90000000000.0]


def test_averages_are_computed_before_a_tumbling_window_becomes_two_rows(readings):
    rows = normalize(readings((1, 20.0, "2026-07-18T08:00:05Z")))
    plan = window_averages(rows, WindowConfig(30, 10))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("AS average_temperature")


def test_average_of_sums_on_both_sides_of_the_bigint_path(spark):
    edge = numbers.BIGINT_SUM
    sums = [0, 1, 5, 149, 150, 151, edge - 1, edge, edge + 1, 2**63 - 1, 2**63, 10**20 + 7]
    data = [(Decimal(sign * s), n) for s in sums for sign in (1, -1) for n in (None, 0, 1, 2, 3, 7, 200, 10**10 + 1)] + [(None, 3), (None, None)]
    data = [(s, n) for s, n in data if abs(s or 0) < (n or 1) * 2**63]  # no reading, and so no average, is larger
    wide = spark.createDataFrame(data, "s decimal(38,0), n bigint")
    small = wide.where("s IS NULL OR abs(s) < 9223372036854775807").withColumn("s", F.col("s").cast("bigint"))

    def mean(s, n):
        if s is None or not n:
            return 0.0
        whole = (abs(int(s)) * 200 + n) // (2 * n)  # ten-thousandths, half away from zero
        return float(whole) / 10000.0 * (1 if s >= 0 else -1)

    for table in (wide, small):
        for r in table.select("s", "n", numbers.average_of("s", "n").alias("mean")).collect():
            assert r["mean"] == mean(r["s"], r["n"]), r
