"""State that outlives the process: written to a log, forgotten, and rebuilt from storage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.operators.state import changelog_of, materialize_changelog, reconcile_states, running_state, truck_totals
from fleetgauge.schemas import CHANGELOG_TOPIC, LOG_ROW
from fleetgauge.sources.changelog import decode_changelog, encode_changelog
from fleetgauge.sources.logs import partition_of
from fleetgauge.sources.segments import Positions, SegmentLog

# Log records in one batch.
BATCH = 1 << 22


def changelog_rows(changelog: DataFrame, order: str = "seq") -> DataFrame:
    """Upserts ``(key, value, seq)`` as log rows: a key stays in one partition, and the order is the offset."""
    return encode_changelog(changelog).select(
        "key",
        "value",
        F.lit(CHANGELOG_TOPIC).alias("topic"),
        partition_of("key").alias("partition"),
        F.col(order).alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )


def changelog_log(spark, location: str) -> SegmentLog:
    return SegmentLog(spark, location, LOG_ROW)


def log_states(normalized: DataFrame, log: SegmentLog, staging: str, order: str = "seq", most: int | None = None) -> list[int]:
    """Write the changelog of the running state to ``log`` in batches of at most ``most`` records. ``staging`` is a
    folder for the records, which are computed once; without ``most`` a batch is a third of them, but no more
    than ``BATCH``."""
    rows = changelog_rows(changelog_of(running_state(normalized, order=order), order), order)
    rows.write.mode("overwrite").parquet(staging)
    staged = normalized.sparkSession.read.schema(rows.schema).parquet(staging)
    return log.append_bounded(staged, most or max(min(BATCH, -(-staged.count() // 3)), 1))


def recovered_state(log: SegmentLog, until: Positions | None = None) -> DataFrame:
    """Live state from the committed records of the log, those up to ``until`` if given."""
    return materialize_changelog(decode_changelog(log.read(until=until)))


def recovery_report(expected: DataFrame, log: SegmentLog) -> DataFrame:
    """The state in the log against the expected totals: one row with the number of records read back, of trucks and of
    mismatches, and PASSED or FAILED. A mismatch is a truck whose state differs, or a file of the log that
    is not what was committed."""
    compared = reconcile_states(expected, recovered_state(log)).agg(
        F.count("*").alias("trucks"), F.count_if(~F.col("matches")).alias("wrong")
    )
    read = log.read().agg(F.count("*").alias("changelog_records"))
    damaged = log.damaged().agg(F.count("*").alias("damaged"))
    parts = compared.unionByName(read, allowMissingColumns=True).unionByName(damaged, allowMissingColumns=True)
    report = parts.agg(
        F.max("changelog_records").alias("changelog_records"),
        F.max("trucks").alias("trucks"),
        (F.max("wrong") + F.max("damaged")).alias("mismatches"),
    )
    return report.withColumn("verdict", F.when(F.col("mismatches") == 0, "PASSED").otherwise("FAILED"))


def leave_torn_batch(log: SegmentLog) -> int:
    """A batch as a writer leaves it that dies before committing: empty states for all keys, behind the last record."""
    last = log.read().groupBy("key", "topic", "partition").agg(F.max("offset").alias("last"))
    torn = last.select(
        "key", F.lit('{"sum":0.0,"count":0}').alias("value"), "topic", "partition", (F.col("last") + 1).alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )
    batch = max(log.batches(), default=-1) + 1
    log.write_segment(torn, batch)
    return batch


def recovery_audit(normalized: DataFrame, location: str, order: str = "seq", most: int | None = None) -> DataFrame:
    """Write the changelog of the running state below ``location`` in bounded batches, leave a torn batch behind it,
    forget the state, rebuild it from storage alone and compare it with the totals of the readings."""
    log = changelog_log(normalized.sparkSession, f"{location}/log")
    log_states(normalized, log, f"{location}/staging", order, most)
    leave_torn_batch(log)
    reopened = changelog_log(normalized.sparkSession, f"{location}/log")
    return recovery_report(truck_totals(normalized), reopened)
