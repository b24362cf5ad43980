"""Streams against tables: several micro-batches must give the batch answer."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from fleetgauge.config import WindowConfig
from fleetgauge.operators.dedup import dedup_readings
from fleetgauge.operators.fleet import fleet_latest
from fleetgauge.operators.normalize import normalize, with_event_time
from fleetgauge.operators.quality import consumer_lag
from fleetgauge.operators.state import materialize_changelog, truck_totals
from fleetgauge.operators.windows import window_averages
from fleetgauge.schemas import LOG_ROW, TELEMETRY_TOPIC
from fleetgauge.sources.averages import read_averages
from fleetgauge.sources.changelog import read_changelog
from fleetgauge.sources.telemetry import read_telemetry
from fleetgauge.streaming.clock import clock_stream, open_clock
from fleetgauge.streaming.queries import (
    dropped_as_duplicate,
    dropped_as_late,
    finish_averages,
    offsets_of,
    start_averages,
    start_snapshot,
    start_state,
)

START = datetime(2026, 1, 1, tzinfo=timezone.utc)
CONFIG = WindowConfig(size=60, step=20, expires=120)


def at(seconds):
    return (START + timedelta(seconds=seconds)).isoformat()


class Feed:
    """Writes log files one by one; a stream reads one per micro-batch."""

    def __init__(self, spark, root):
        self.spark, self.root, self.offset = spark, root, 0

    def send(self, *readings):
        data = []
        for truck, temperature, timestamp in readings:
            value = json.dumps({"truck_id": truck, "temperature": temperature, "timestamp": timestamp})
            data.append((str(truck), value, TELEMETRY_TOPIC, 0, self.offset, START))
            self.offset += 1
        self.spark.createDataFrame(data, LOG_ROW).coalesce(1).write.mode("append").parquet(f"{self.root}/log")

    def stream(self):
        return read_telemetry(self.spark, f"{self.root}/log", streaming=True, maxFilesPerTrigger="1")

    def table(self):
        return read_telemetry(self.spark, f"{self.root}/log")

    def averages(self):
        """Run the averages query over what is there and return its progress reports."""
        query = start_averages(self.stream(), f"{self.root}/out", f"{self.root}/checkpoint", CONFIG)
        query.awaitTermination()
        return [json.loads(p.json) for p in query.recentProgress]

    def closed(self):
        if not list(self.root.glob("out/*.parquet")):
            return []
        return key_rows(read_averages(self.spark, f"{self.root}/out"))


def key_rows(averages):
    return sorted(
        (r.truck_id, r.window_type, str(r.window_start), r.average_temperature, r.reading_count)
        for r in averages.collect()
    )


def batch_rows(table, before=None):
    averages = window_averages(normalize(dedup_readings(with_event_time(table))), CONFIG)
    if before is not None:
        averages = averages.where(F.col("window_end") <= F.lit(before))
    return key_rows(averages)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


ADVANCE = (9, 25.0, at(10_000))


def test_micro_batches_give_the_batch_answer(feed):
    feed.send((1, 30.0, at(1)), (1, 30.0, at(1)), (2, -5.0, at(2)), (1, 31.0, at(61)))
    feed.send((1, 99.0, at(1)), (2, 50.0, at(2)), (2, 7.5, at(70)), (1, 12.25, "not-a-timestamp"))
    feed.send((1, 40.0, at(30)), (2, 41.0, at(130)))
    assert feed.averages() and feed.closed() == batch_rows(feed.table(), START)
    feed.send(ADVANCE)
    feed.averages()
    # Everything but the windows of the advancing reading, which are still open.
    expected = batch_rows(feed.table(), START + timedelta(seconds=9_000))
    assert feed.closed() == expected and len(expected) > 5
    # The key of the dropped first reading of truck 2 stays taken.
    assert not [r for r in expected if r[0] == 2 and r[3] == 50.0]


def test_open_windows_are_not_emitted(feed):
    feed.send((1, 30.0, at(1)))
    feed.send((1, 30.0, at(179)))
    feed.averages()
    # The clock stands at 59 s: of the windows around the first reading only those that end by then are out.
    assert {r[2][-8:] for r in feed.closed()} == {"23:59:20", "23:59:40"}


def test_late_reading_changes_no_closed_window(feed):
    feed.send((1, 30.0, at(1)))
    feed.send(ADVANCE)
    feed.averages()
    before = feed.closed()
    assert before
    feed.send((1, 90.0, at(2)))
    progress = feed.averages()
    assert feed.closed() == before
    assert sum(dropped_as_late(p) for p in progress) >= 1


def test_restart_loses_and_doubles_nothing(feed):
    """Each call stops the query and starts it again from its checkpoint."""
    feed.send((1, 30.0, at(1)), (2, 20.0, at(5)))
    feed.averages()
    feed.send((1, 30.0, at(1)), (1, 32.0, at(2)))
    feed.averages()
    feed.send((2, 20.0, at(5)), (2, 22.0, at(50)))
    feed.averages()
    feed.send(ADVANCE)
    feed.averages()
    feed.averages()
    assert feed.closed() == batch_rows(feed.table(), START + timedelta(seconds=9_000))


def test_windows_that_are_no_whole_number_of_hops(spark, feed):
    uneven = WindowConfig(size=60, step=25, expires=120)
    feed.send(*[(1 + i % 2, 10.0 + i, at(7 * i)) for i in range(30)])
    feed.send(ADVANCE)
    start_averages(feed.stream(), f"{feed.root}/out", f"{feed.root}/checkpoint", uneven).awaitTermination()
    averages = window_averages(normalize(dedup_readings(with_event_time(feed.table()))), uneven)
    assert feed.closed() == key_rows(averages.where("truck_id < 9"))


def finished(feed, until=None):
    root = feed.root
    finish_averages(feed.stream(), f"{root}/out", f"{root}/checkpoint", f"{root}/clock", CONFIG, until=until)
    return feed.closed()


def test_markers_close_the_last_windows(feed):
    feed.send((1, 30.0, at(1)), (1, 30.0, at(1)), (2, -5.0, at(2)), (1, 31.0, at(61)))
    feed.send((1, 40.0, at(30)), (2, 41.0, at(130)), (None, 5.0, at(3)), (3, 9.0, "not-a-timestamp"))
    everything = batch_rows(feed.table())
    assert finished(feed) == everything and len(everything) > 10
    # Nothing comes out twice or with a marker in it, however often the clock is set.
    assert finished(feed) == everything
    assert finished(feed, START + timedelta(days=1)) == everything
    assert all(r[0] is not None for r in feed.closed())


def test_readings_of_closed_windows_are_late_and_newer_ones_go_on(feed):
    feed.send((1, 30.0, at(1)))
    first = finished(feed)
    feed.send((1, 99.0, at(2)), (1, 50.0, at(50_000)))
    rest = [r for r in finished(feed) if r not in first]
    table = feed.table().where("temperature <> 99.0")
    assert sorted(first + rest) == batch_rows(table)


def test_a_stream_without_readings_has_nothing_to_close(feed):
    feed.send()
    assert finished(feed) == []


def test_a_marker_after_a_failure_between_the_runs(spark, feed):
    feed.send((1, 30.0, at(1)))
    open_clock(spark, f"{feed.root}/clock")
    markers = clock_stream(spark, f"{feed.root}/clock")
    start_averages(feed.stream(), f"{feed.root}/out", f"{feed.root}/checkpoint", CONFIG, clock=markers).awaitTermination()
    assert feed.closed() != batch_rows(feed.table())
    assert finished(feed, START + timedelta(seconds=1 + 2 * CONFIG.expires + CONFIG.size)) == batch_rows(feed.table())


def states(feed):
    start_state(feed.stream(), f"{feed.root}/changes", f"{feed.root}/state").awaitTermination()
    live = materialize_changelog(read_changelog(feed.spark, f"{feed.root}/changes"))
    return sorted(tuple(r) for r in live.collect())


def test_running_state_survives_restarts(feed):
    feed.send((1, 30.0, at(1)), (1, 36.0, at(2)), (2, 41.0, at(1)))
    assert states(feed) == [(1, 66.0, 2, 33.0), (2, 41.0, 1, 41.0)]
    feed.send((1, 30.0, at(1)), (1, 0.0, at(3)), (1, 1.0, at(4)))
    feed.send((3, 5.0, at(5)))
    expected = truck_totals(normalize(dedup_readings(with_event_time(feed.table()))))
    assert states(feed) == sorted(tuple(r) for r in expected.collect())


def test_each_batch_of_the_changelog_has_one_folder(feed):
    """A batch that runs again replaces its folder, so nothing is doubled."""
    feed.send((1, 30.0, at(1)))
    feed.send((1, 31.0, at(2)))
    states(feed)
    rows = feed.spark.read.parquet(f"{feed.root}/changes").collect()
    assert sorted((r.seq, r.batch, json.loads(r.value)["count"]) for r in rows) == [(0, 0, 1), (1, 1, 2)]


def test_snapshot_publishes_the_latest_values(feed):
    published = {}

    def publish(rows, batch):
        published.update({r.truck_id: tuple(r) for r in rows.collect()})

    feed.send((1, 30.0, at(1)), (2, -1.0, at(1)))
    feed.send((1, None, at(2)), (1, 99.0, at(1)))
    query = start_snapshot(feed.stream(), publish, f"{feed.root}/snapshot")
    query.awaitTermination()
    expected = fleet_latest(dedup_readings(feed.table()).where("temperature IS NULL OR temperature > 0"))
    assert published == {r.truck_id: tuple(r) for r in expected.collect()}
    reports = [json.loads(p.json) for p in query.recentProgress]
    assert sum(dropped_as_duplicate(p) for p in reports) == 1


def test_lag_from_a_progress_report(spark):
    progress = {
        "sources": [{"latestOffset": {"t": {"0": 10, "1": 5}}, "endOffset": {"t": {"0": 4}}}],
    }
    found = {r.topic: r.lag for r in consumer_lag(offsets_of(spark, progress)).collect()}
    assert found == {"t": 6, None: 6}


def test_offsets_of_a_live_report_are_text(spark):
    source = {"latestOffset": '{"readings": {"0": 10, "1": 7}}', "endOffset": '{"readings": {"0": 4}}'}
    found = offsets_of(spark, {"sources": [source]}).orderBy("partition").collect()
    assert [(r.partition, r.high, r.committed) for r in found] == [(0, 10, 4), (1, 7, None)]
