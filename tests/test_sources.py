import json

import pytest
from pyspark.sql import functions as F

from fleetgauge.operators.normalize import normalize
from fleetgauge.operators.state import changelog_of, materialize_changelog, running_state, truck_totals
from fleetgauge.operators.windows import window_averages
from fleetgauge.schemas import LOG_ROW, TELEMETRY_TOPIC, TELEMETRY_V1
from fleetgauge.sources.averages import read_averages, write_averages
from fleetgauge.sources.changelog import read_changelog, write_changelog
from fleetgauge.sources.fleet_csv import fleet_event_time, read_fleet_csv, write_fleet_csv
from fleetgauge.sources.logs import partition_of, read_log, spread_for_write
from fleetgauge.sources.telemetry import decode_readings, encode_readings, read_telemetry, unite_versions

CLOCK = "2026-07-22T10:00:00+00:00"


def log(spark, *values):
    data = [("k", v, TELEMETRY_TOPIC, i % 2, i // 2, None) for i, v in enumerate(values)]
    return spark.createDataFrame(data, LOG_ROW)


def test_reads_telemetry_from_files(spark, tmp_path):
    good = json.dumps({"truck_id": 101, "temperature": 38.4, "timestamp": CLOCK, "fuel_level": 82.5})
    log(spark, good, "{bad", '{"truck_id": "one", "temperature": 1, "timestamp": "t"}').write.parquet(f"{tmp_path}/log")
    found = read_telemetry(spark, f"{tmp_path}/log").orderBy("seq").collect()
    assert [r.truck_id for r in found] == [101, None, None]
    assert (found[0].temperature, found[0].fuel_level, found[0].latitude) == (38.4, 82.5, None)
    # The second partition counts from its own base, after the first.
    assert [r.seq for r in found] == [0, 1, 1 << 48]


def test_other_topics_are_not_read(spark, tmp_path):
    log(spark, "{}").withColumn("topic", F.lit("other")).write.parquet(f"{tmp_path}/log")
    assert read_log(spark, f"{tmp_path}/log", topic=TELEMETRY_TOPIC).count() == 0


def test_json_files_have_the_same_columns(spark, tmp_path):
    log(spark, "{}").write.json(f"{tmp_path}/log")
    assert read_log(spark, f"{tmp_path}/log", "json").columns == LOG_ROW.names


def test_kafka_options_are_checked_before_the_connector_is_needed(spark):
    with pytest.raises(ValueError):
        read_log(spark, "broker:9092", "kafka")
    with pytest.raises(ValueError):
        read_log(spark, "broker:9092", "kafka", topic="t", start="latest")


def test_old_reader_ignores_new_fields_and_new_reader_fills_missing_ones(spark):
    v2 = log(spark, json.dumps({"truck_id": 101, "temperature": 38.4, "timestamp": CLOCK, "fuel_level": 82.5}))
    v1 = log(spark, json.dumps({"truck_id": 7, "temperature": 1.5, "timestamp": CLOCK}))
    old = decode_readings(v2, TELEMETRY_V1)
    assert old.columns == ["truck_id", "temperature", "timestamp", "seq", "arrival"]
    assert old.first().truck_id == 101
    assert decode_readings(v1).first().fuel_level is None
    both = unite_versions(old, decode_readings(v2))
    assert sorted((r.fuel_level is None) for r in both.collect()) == [False, True]


def test_encoded_reading(readings):
    row = encode_readings(readings((3, 20.5, "t", None, 1.0, None))).first()
    assert row.key == "3"
    assert json.loads(row.value) == {
        "truck_id": 3, "temperature": 20.5, "timestamp": "t", "fuel_level": None, "latitude": 1.0, "longitude": None,
    }


def test_averages_round_trip(spark, readings, tmp_path, rows):
    averages = window_averages(normalize(readings((1, 30.0, CLOCK), (1, 31.0, CLOCK), (2, 5.25, CLOCK))))
    averages = averages.withColumn("computed_at", F.col("window_end"))
    write_averages(averages, f"{tmp_path}/averages")
    write_averages(averages.limit(0), f"{tmp_path}/averages")
    assert sorted(rows(read_averages(spark, f"{tmp_path}/averages"))) == sorted(rows(averages))
    raw = spark.read.parquet(f"{tmp_path}/averages").where("key = '2'").first()
    assert json.loads(raw.value)["window_end"].endswith("+00:00")


def test_changelog_round_trip(spark, readings, tmp_path, rows):
    df = normalize(readings((1, 30.0, "2026-01-01"), (1, 36.0, "2026-01-02"), (2, 41.0, "2026-01-01")))
    log = changelog_of(running_state(df))
    write_changelog(log, f"{tmp_path}/log")
    deleted = spark.createDataFrame([("truck:2", None, 99)], "key string, value struct<sum: double, count: bigint>, seq bigint")
    write_changelog(deleted, f"{tmp_path}/log")
    live = materialize_changelog(read_changelog(spark, f"{tmp_path}/log"))
    assert rows(live) == rows(truck_totals(df.where("truck_id = 1")))


def test_fleet_csv(spark, tmp_path):
    path = tmp_path / "fleet.csv"
    path.write_text(
        "timestamp,truck_id,temperature,fuel,latitude,longitude,driver\n"
        "18-06-2026 00:30,UNIT-01234,-25.0,50.0,24.5,-70.25,x\n"
        "2026-06-18,UNIT-00001,,50.0,24.5,-70.25,y\n"
    )
    dataset = fleet_event_time(read_fleet_csv(spark, str(path)))
    first, second = dataset.collect()
    assert (first.truck_id, first.temperature, first.driver) == ("UNIT-01234", -25.0, "x")
    assert first.event_time.isoformat() == "2026-06-18T00:30:00" and second.event_time is None
    assert second.temperature is None
    write_fleet_csv(dataset.drop("event_time"), f"{tmp_path}/copy")
    assert read_fleet_csv(spark, f"{tmp_path}/copy").columns == dataset.drop("event_time").columns


def test_a_truck_keeps_its_partition(spark, tmp_path):
    df = spark.range(2000).selectExpr("id % 100 + 1 AS truck_id", "id AS seq")
    spread_for_write(df).write.partitionBy("partition").parquet(f"{tmp_path}/out")
    found = spark.read.parquet(f"{tmp_path}/out")
    assert found.count() == 2000
    assert found.where(F.col("partition") != partition_of("truck_id")).count() == 0
    assert found.agg(F.min("partition"), F.max("partition")).first()[:] <= (0, 19)
