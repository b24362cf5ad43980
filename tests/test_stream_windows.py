"""The open windows of a stream, which lie in files beside its position."""

import json
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from fleetgauge.config import WindowConfig
from fleetgauge.operators.dedup import dedup_readings
from fleetgauge.operators.normalize import normalize, with_event_time
from fleetgauge.operators.windows import window_averages
from fleetgauge.schemas import LOG_ROW, TELEMETRY_TOPIC
from fleetgauge.sources.averages import read_averages
from fleetgauge.sources.telemetry import read_telemetry
from fleetgauge.streaming.queries import finish_averages, start_averages

START = datetime(2026, 1, 1, tzinfo=timezone.utc)
EVEN = WindowConfig(size=60, step=20, expires=30)
UNEVEN = WindowConfig(size=60, step=25, expires=30)


def at(seconds):
    return (START + timedelta(seconds=seconds)).isoformat()


def send(spark, root, first_offset, *readings):
    data = []
    for offset, (truck, temperature, timestamp) in enumerate(readings, first_offset):
        value = json.dumps({"truck_id": truck, "temperature": temperature, "timestamp": timestamp})
        data.append((str(truck), value, TELEMETRY_TOPIC, 0, offset, START))
    spark.createDataFrame(data, LOG_ROW).coalesce(1).write.mode("append").parquet(f"{root}/log")


def stream(spark, root):
    return read_telemetry(spark, f"{root}/log", streaming=True, maxFilesPerTrigger="1")


def averages(spark, root, config=EVEN):
    query = start_averages(stream(spark, root), f"{root}/out", f"{root}/checkpoint", config)
    query.awaitTermination()
    return [json.loads(p.json) for p in query.recentProgress]


def rows(table):
    return sorted(
        (r.truck_id, r.window_type, str(r.window_start), r.average_temperature, r.reading_count) for r in table.collect()
    )


def written(spark, root):
    return rows(read_averages(spark, f"{root}/out"))


def expected(spark, root, config=EVEN):
    table = read_telemetry(spark, f"{root}/log")
    return rows(window_averages(normalize(dedup_readings(with_event_time(table))), config))


def test_only_the_duplicate_filter_has_a_state_store(spark, tmp_path):
    send(spark, tmp_path, 0, (1, 30.0, at(1)), (1, 31.0, at(61)), (2, 40.0, at(90)), (9, 25.0, at(10_000)))
    progress = averages(spark, tmp_path)
    assert progress and all(len(p["stateOperators"]) == 1 for p in progress)
    assert written(spark, tmp_path) == [r for r in expected(spark, tmp_path) if r[0] != 9]


@pytest.mark.parametrize("config", [EVEN, UNEVEN])
def test_many_batches_that_close_some_windows_each(spark, tmp_path, config):
    draw = random.Random(7)
    for batch in range(3):
        # Up to a minute out of order, but never behind the watermark.
        readings = [(draw.randint(1, 3), draw.randint(1, 5_000) / 100, at(40 * batch + draw.randint(0, 25))) for _ in range(25)]
        send(spark, tmp_path, 100 * batch, *readings, *readings[:9])
    work = [f"{tmp_path}/{name}" for name in ("out", "checkpoint", "clock")]
    finish_averages(stream(spark, tmp_path), *work, config)
    assert written(spark, tmp_path) == expected(spark, tmp_path, config)
    # What is left beside the position holds no window that has been given out.
    kinds = [p.name.split("-")[0] for p in (tmp_path / "checkpoint" / "windows").iterdir()]
    assert 0 < kinds.count("base") <= 2 and kinds.count("delta") < 4


def test_a_batch_that_runs_again_leaves_one_copy(spark, tmp_path):
    send(spark, tmp_path, 0, (1, 30.0, at(1)), (2, 20.0, at(5)))
    send(spark, tmp_path, 10, (1, 33.0, at(30)), (9, 25.0, at(95)))
    averages(spark, tmp_path)
    before = written(spark, tmp_path)
    assert before
    # As after a failure between the sink and the commit.
    commits = tmp_path / "checkpoint" / "commits"
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        (commits / name).unlink(missing_ok=True)
    averages(spark, tmp_path)
    assert written(spark, tmp_path) == before
    send(spark, tmp_path, 20, (1, 35.0, at(100)), (9, 25.0, at(10_000)))
    averages(spark, tmp_path)
    assert written(spark, tmp_path) == [r for r in expected(spark, tmp_path) if r[2] < str(START + timedelta(hours=1))]


def test_a_text_that_is_no_time_does_not_move_the_clock(spark, tmp_path):
    send(spark, tmp_path, 0, (1, 30.0, "soon"), (2, 30.0, "later"))
    send(spark, tmp_path, 10, (1, 30.0, at(1)), (1, 31.0, "soon"))
    work = [f"{tmp_path}/{name}" for name in ("out", "checkpoint", "clock")]
    finish_averages(stream(spark, tmp_path), *work, EVEN)
    assert written(spark, tmp_path) == expected(spark, tmp_path)


def test_another_query_writes_beside_the_first(spark, tmp_path):
    send(spark, tmp_path, 0, (1, 30.0, at(1)), (9, 25.0, at(10_000)))
    averages(spark, tmp_path)
    once = written(spark, tmp_path)
    start_averages(stream(spark, tmp_path), f"{tmp_path}/out", f"{tmp_path}/other", EVEN).awaitTermination()
    assert written(spark, tmp_path) == sorted(once * 2)
    assert read_averages(spark, f"{tmp_path}/out").where(F.col("truck_id") == 9).count() == 0
