"""Logs in committed batches, and state that is rebuilt, continued, merged and looked up from them."""

import json
from datetime import datetime, timedelta, timezone
from pathlib import Path
from shutil import copyfile

import pytest
from pyspark.sql import functions as F

from fleetgauge.operators.recovery import changelog_log, leave_torn_batch, log_states, recovered_state, recovery_report
from fleetgauge.operators.snapshots import StateHistory
from fleetgauge.operators.state import materialize_changelog, state_as_of_offsets, truck_totals
from fleetgauge.operators.state_table import Conflict, StateTable
from fleetgauge.schemas import LOG_ROW
from fleetgauge.sources.changelog import decode_changelog
from fleetgauge.sources.segments import SegmentLog
from fleetgauge.streaming.resume import start_logged_state

START = datetime(2026, 1, 1, tzinfo=timezone.utc)


def entry(truck, count, offset, partition=None, total=None):
    """A log row of a truck's state, or of its deletion."""
    value = None if count is None else json.dumps({"sum": float(count if total is None else total), "count": count})
    place = truck % 3 if partition is None else partition
    return (f"truck:{truck}", value, "t", place, offset, START + timedelta(seconds=offset))


@pytest.fixture
def rows(spark):
    return lambda entries: spark.createDataFrame(entries, LOG_ROW).coalesce(2)


@pytest.fixture
def log(spark, tmp_path):
    return SegmentLog(spark, f"{tmp_path}/log", LOG_ROW)


def offsets(df):
    return sorted(r.offset for r in df.collect())


def live(df):
    return sorted(tuple(r) for r in df.collect())


def test_only_committed_batches_are_read(spark, rows, log):
    assert offsets(log.read()) == [] and log.batches() == set()
    assert log.append(rows([entry(1, 1, 0), entry(2, 1, 1)])) == 0
    log.write_segment(rows([entry(1, 9, 2)]), 1)
    assert offsets(log.read()) == [0, 1] and log.batches() == {0}
    # The batch is in its place, so that writing it again commits what is there.
    log.append(rows([entry(1, 9, 2)]), 1)
    log.append(rows([entry(1, 7, 50)]), 1)
    assert offsets(log.read()) == [0, 1, 2] and offsets(log.read_batch(1)) == [2]
    assert log.ends() == {1: 2, 2: 1}
    with pytest.raises(KeyError):
        log.read_batch(5)
    # What a writer that died has left in the hidden folder is replaced.
    rows([entry(3, 1, 99)]).write.parquet(f"{log.location}/segments/_batch=2")
    log.append(rows([entry(3, 1, 3)]), 2)
    assert offsets(log.read()) == [0, 1, 2, 3]


def test_an_empty_batch_keeps_its_number(rows, log):
    log.append(rows([entry(1, 1, 0)]))
    assert log.append(rows([entry(1, 1, 1)]).where("false")) == 1
    assert log.append(rows([entry(1, 2, 2)])) == 2
    assert offsets(log.read()) == [0, 2]


def test_positions_prune_files(spark, rows, log):
    for k in range(4):
        log.append(rows([entry(t, 1, 10 * k + t) for t in range(6)]))
    files = {k: {f for f in log.files() if f"batch={k}" in f} for k in range(4)}
    assert all(files.values())
    behind = log.read(after={0: 13, 1: 11, 2: 12})
    assert offsets(behind) == [14, 15] + [10 * k + t for k in (2, 3) for t in range(6)]
    assert not {f.split("/")[-1] for f in behind.inputFiles()} & {f.split("/")[-1] for f in files[0]}
    until = log.read(until={0: 13, 2: 5})
    assert offsets(until) == [0, 2, 3, 5, 10, 13]
    assert {f.split("batch=")[1][0] for f in until.inputFiles()} <= {"0", "1"}
    late = log.read(since=START + timedelta(seconds=31), before=START + timedelta(seconds=33))
    assert offsets(late) == [31, 32] and {f.split("batch=")[1][0] for f in late.inputFiles()} == {"3"}
    position = log.position_of_time(START + timedelta(seconds=12))
    assert offsets(log.read(after=position)) == offsets(log.read(since=START + timedelta(seconds=12)))
    assert offsets(log.read(after=log.ends())) == []  # from the latest on


def test_batches_are_bounded(rows, log):
    seen = []
    numbers = log.append_bounded(rows([entry(i % 7, 1, i) for i in range(500)]), 60, after=seen.append)
    assert numbers == seen == list(range(len(numbers))) and offsets(log.read()) == list(range(500))
    assert max(log.read_batch(n).count() for n in numbers) <= 60
    assert log.append_bounded(rows([entry(1, 1, 1)]).where("false"), 10) == []


def normalized(spark, n=40):
    data = [(i % 4, 100 + i, i) for i in range(n)]
    return spark.createDataFrame(data, "truck_id bigint, temperature_centi bigint, seq bigint")


@pytest.fixture
def states(spark, tmp_path):
    """A changelog in three batches and the expected totals."""
    log = changelog_log(spark, f"{tmp_path}/log")
    log_states(normalized(spark), log, f"{tmp_path}/staging", most=15)
    return log


def verdict(spark, log):
    return recovery_report(truck_totals(normalized(spark)), log).first()


def test_recovery_from_storage(spark, states):
    assert len(states.batches()) >= 3
    leave_torn_batch(states)
    again = changelog_log(spark, states.location)
    assert tuple(verdict(spark, again)) == (40, 4, 0, "PASSED")
    # Up to an offset: the state as it was then.
    half = {p: 19 for p in states.ends()}
    want = truck_totals(normalized(spark, 20))
    assert live(recovered_state(again, half)) == live(want)


def _damaged(spark, states, change):
    """Rewrite one committed file."""
    file = states.files()[0]
    rows = change(spark.read.schema(LOG_ROW).parquet(file)).collect()
    spark.createDataFrame(rows, LOG_ROW).coalesce(1).write.parquet(f"{states.location}/changed")
    (new,) = spark.read.parquet(f"{states.location}/changed").inputFiles()
    copyfile(new.removeprefix("file://"), file)
    Path(file).with_name(f".{Path(file).name}.crc").unlink(missing_ok=True)
    spark.catalog.refreshByPath(states.location)


@pytest.mark.parametrize("change", [
    lambda df: df.withColumn("value", F.when(F.monotonically_increasing_id() > 0, F.col("value")).otherwise('{"sum":1.0,"count":9}')),
    lambda df: df.where(F.monotonically_increasing_id() > 0),
    lambda df: df.union(df.limit(1)),
], ids=["changed", "lost", "doubled"])
def test_a_damaged_record_fails_the_audit(spark, states, change):
    assert verdict(spark, states).verdict == "PASSED"
    _damaged(spark, states, change)
    found = verdict(spark, states)
    assert found.mismatches > 0 and found.verdict == "FAILED"


def test_a_lost_batch_fails_the_audit(spark, tmp_path):
    log = changelog_log(spark, f"{tmp_path}/log")
    log_states(normalized(spark, 30), log, f"{tmp_path}/staging", most=15)
    assert verdict(spark, log).mismatches == 4


def deletions():
    """Upserts and deletions of many keys, some deleted for good, some written again."""
    out = []
    for i in range(240):
        truck = i * 7 % 30
        out.append(entry(truck, None if (i + truck) % 5 == 0 else i, i))
    return out


def test_small_merges_equal_full_replay(spark, rows, tmp_path):
    data = deletions()
    table = StateTable(spark, f"{tmp_path}/table", buckets=4)
    assert live(table.live()) == [] and table.version() == -1
    for k in range(8):
        table.apply(decode_changelog(rows(data[30 * k:30 * k + 30])).drop("partition"), k)
        table.merge(least=3)
        want = live(materialize_changelog(decode_changelog(rows(data[:30 * k + 30]))))
        assert live(table.live()) == want
    before = table.version()
    table.apply(decode_changelog(rows(data[:30])), 3)  # applied long ago
    assert table.version() == before and table.applied() == 7
    # After a merge of everything there are no deletions left, and each key is there once.
    table.merge(least=1)
    left = table.entries()
    assert left.where("value IS NULL").count() == 0 and left.count() == left.select("key").distinct().count() == len(want)


def test_a_merge_rewrites_touched_buckets_alone(spark, rows, tmp_path):
    table = StateTable(spark, f"{tmp_path}/table", buckets=8)
    table.apply(decode_changelog(rows([entry(t, 1, t) for t in range(40)])), 0)
    table.merge(least=1)
    first = {r.bucket: r.generation for r in table.manifest()}
    assert len(first) > 3
    for k in range(2):
        table.apply(decode_changelog(rows([entry(5, 5 + k, 100 + k)])), 1 + k)
    (touched,) = table.merge(least=2)
    second = {r.bucket: r.generation for r in table.manifest()}
    assert {b for b in first if first[b] != second[b]} == {touched}
    old = table.version() - 1  # readers of the version before see what it was
    assert live(table.live(old)) == live(table.live())
    version, held = table.version(), table.manifest()
    table._publish(version + 1, [tuple(r)[:4] for r in held], 9)
    with pytest.raises(Conflict):
        table._publish(version + 1, [], 9)


def test_snapshots_and_the_tail_behind_them(spark, rows, log, tmp_path):
    history = StateHistory(log, f"{tmp_path}/snapshots")
    assert history.take() is None
    data = deletions()
    for k in range(6):
        log.append(rows(data[40 * k:40 * k + 40]))
        if k % 2:
            history.take()
    assert history.take() is None and [s.at for s in history.snapshots()] == [0, 1, 2]
    for offsets_at in ({0: 130, 1: 131, 2: 132}, {0: 159, 1: 158, 2: 157}, {0: 10, 1: 10, 2: 10}, {0: 500, 1: 500, 2: 500},
                       {0: 200, 1: 90, 2: 200}, {0: 239}, {}):
        at = spark.createDataFrame(list(offsets_at.items()), "partition int, offset bigint")
        want = state_as_of_offsets(decode_changelog(log.read()), at)
        assert live(history.state_at(offsets_at)) == live(want)
    found = history.state_at({0: 130, 1: 131, 2: 132})
    assert history.nearest({0: 130, 1: 131, 2: 132}).at == 0
    read = {f.split("batch=")[1][0] for f in found.inputFiles() if "batch=" in f}
    assert read == {"2", "3"} and any("/state/at=0" in f for f in found.inputFiles())


def reading(truck, temperature, second, offset):
    value = json.dumps({"truck_id": truck, "temperature": temperature, "timestamp": (START + timedelta(seconds=second)).isoformat()})
    return (str(truck), value, "truck-telemetry", truck % 3, offset, START + timedelta(seconds=offset))


def test_a_stream_without_its_checkpoint_goes_on_from_the_changelog(spark, rows, log, tmp_path):
    changelog = SegmentLog(spark, f"{tmp_path}/changelog", LOG_ROW)

    def state(checkpoint, **how):
        start_logged_state(log, changelog, f"{tmp_path}/{checkpoint}", **how).awaitTermination()
        return {r.truck_id: (r["sum"], r["count"]) for r in materialize_changelog(decode_changelog(changelog.read())).collect()}

    log.append(rows([reading(1, 30.0, 1, 0), reading(2, 20.5, 1, 1), reading(1, -3.0, 2, 2), reading(1, 31.0, 3, 3)]))
    assert state("first") == {1: (61.0, 2), 2: (20.5, 1)}
    # Copies of old readings, one of a filtered one, a new reading, and a truck that is new.
    log.append(rows([reading(1, 30.0, 1, 4), reading(1, 99.0, 2, 5), reading(1, 1.25, 4, 6), reading(3, 7.0, 1, 7)]))
    assert state("second") == {1: (62.25, 3), 2: (20.5, 1), 3: (7.0, 1)}
    assert state("second") == {1: (62.25, 3), 2: (20.5, 1), 3: (7.0, 1)}  # with its checkpoint, nothing new
    log.append(rows([reading(2, 0.5, 9, 8), reading(3, 7.0, 1, 9)]))
    assert state("second") == {1: (62.25, 3), 2: (21.0, 2), 3: (7.0, 1)}
    log.append(rows([reading(2, 4.0, 10, 10), reading(1, 31.0, 3, 11)]))
    assert state("third", horizon=timedelta(days=1)) == {1: (62.25, 3), 2: (25.0, 3), 3: (7.0, 1)}
