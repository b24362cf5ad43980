import json
from datetime import datetime, timedelta, timezone
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from fleetgauge.config import DEFAULT_WINDOWS, DEMO_WINDOWS, WindowConfig
from fleetgauge.jobs import run
from fleetgauge.schemas import LOG_ROW, TELEMETRY_TOPIC
from fleetgauge.session import shared_dir
from fleetgauge.sources.averages import read_averages
from fleetgauge.sources.segments import SegmentLog
from fleetgauge.sources.telemetry import read_telemetry

START = datetime(2026, 1, 1, tzinfo=timezone.utc)


def test_durations_from_the_environment():
    assert WindowConfig.from_env({}) == DEFAULT_WINDOWS
    assert WindowConfig.from_env({"DEMO_MODE": "Yes"}) == DEMO_WINDOWS
    assert WindowConfig.from_env({"DEMO_MODE": "1", "WINDOW_SIZE_SECONDS": "90"}) == WindowConfig(90, 10, 120)


@pytest.fixture
def log(spark, tmp_path):
    """Six readings of three trucks sent twice, then one reading per truck far ahead."""
    batch = [
        (truck, 30.0 + truck + i * 0.5, (START + timedelta(milliseconds=100 * i)).isoformat())
        for i in range(6)
        for truck in (1, 2, 3)
    ]
    ahead = [(truck, 25.0, (START + timedelta(minutes=2)).isoformat()) for truck in (1, 2, 3)]
    rows = [
        (str(t), json.dumps({"truck_id": t, "temperature": c, "timestamp": s}), TELEMETRY_TOPIC, 0, i, START)
        for i, (t, c, s) in enumerate([*batch, *batch, *ahead])
    ]
    spark.createDataFrame(rows, LOG_ROW).coalesce(1).write.parquet(f"{tmp_path}/log")
    return f"{tmp_path}/log"


def test_exactly_once_from_log_to_verdict(spark, log, tmp_path, capsys):
    short = {"WINDOW_SIZE_SECONDS": "10", "HOPPING_STEP_SECONDS": "10", "WINDOW_EXPIRES_SECONDS": "12"}
    work = [f"{tmp_path}/averages", f"{tmp_path}/checkpoint"]
    assert run(spark, ["averages", log, *work, "--start", "earliest"], short) == 0
    # The readings two minutes ahead only move the clock; neither side of the audit counts them.
    cutoff = (START + timedelta(minutes=2)).isoformat()
    code = run(spark, ["exactly-once", log, work[0], "--cutoff", cutoff])
    report = json.loads(capsys.readouterr().out.splitlines()[-1])
    assert (report["counted"], report["distinct_sent"], report["total_sent"]) == (18, 18, 36)
    assert (code, report["verdict"]) == (0, "PASSED")
    assert run(spark, ["exactly-once", log, work[0]]) == 2


def test_start_positions_of_a_log_in_batches(spark, log, tmp_path):
    rows = spark.read.schema(LOG_ROW).parquet(log).withColumn("timestamp", F.lit(START) + F.col("offset") * F.expr("INTERVAL 1 SECOND"))
    segments = SegmentLog(spark, f"{tmp_path}/segments", LOG_ROW)
    segments.append(rows.where("offset < 20"))

    def read(start, **how):
        found = read_telemetry(spark, segments.location, "segments", start=start, **how)
        return sorted(r.seq for r in found.collect())

    assert read("earliest") == list(range(20)) and read("latest") == []
    assert read('{"0": 17}') == [17, 18, 19]
    assert read((START + timedelta(seconds=5)).isoformat()) == list(range(5, 20))
    # A stream keeps where it started, and goes on from there when the log has grown.
    with pytest.raises(ValueError):
        read_telemetry(spark, segments.location, "segments", streaming=True, start="latest")
    short = {"WINDOW_SIZE_SECONDS": "10", "HOPPING_STEP_SECONDS": "10", "WINDOW_EXPIRES_SECONDS": "12"}
    job = ["averages", segments.location, f"{tmp_path}/out", f"{tmp_path}/cp", "--format", "segments", "--start", "latest"]
    assert run(spark, job, short) == 0
    segments.append(rows.where("offset >= 20"))
    assert run(spark, [*job, "--finish"], short) == 0
    counted = read_averages(spark, f"{tmp_path}/out").where("window_type = 'tumbling'").agg({"reading_count": "sum"}).first()[0]
    assert counted == read_telemetry(spark, segments.location, "segments", start='{"0": 20}').select("truck_id", "timestamp").distinct().count()


def test_recovery_and_totals(spark, log, capsys):
    assert run(spark, ["recovery", log]) == 0
    assert json.loads(capsys.readouterr().out)["changelog_records"] == 21
    assert run(spark, ["totals", log]) == 0
    report = json.loads(capsys.readouterr().out)
    assert (report["total_raw"], report["duplicates"], report["active_trucks"]) == (39, 18, 3)


def test_validate_dataset(spark, tmp_path, capsys):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text("truck_id,temperature,timestamp\nUNIT-1,20.5,18-06-2026 00:00\nUNIT-2,-3.0,18-06-2026 00:00\n")
    bad.write_text("truck_id,temperature\nUNIT-1,20.5\n")
    assert run(spark, ["validate-dataset", str(good)]) == 0
    assert json.loads(capsys.readouterr().out)["valid"] == 1
    assert run(spark, ["validate-dataset", str(bad)]) == 1


def test_work_folders_follow_the_checkpoint_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(f"{root}/fleetgauge/x-")
    assert shared_dir(spark, "x") != shared_dir(spark, "x")


def test_work_folders_without_the_setting_are_below_the_warehouse():
    """Whatever the master is: never a folder of one machine's own choice."""
    unset = {"spark.sql.warehouse.dir": "hdfs://store/warehouse"}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: unset.get(key, default)))
    assert shared_dir(session, "x").startswith("hdfs://store/warehouse/fleetgauge/x-")
