"""Keyed logs in the shape of the Kafka source, from Kafka itself or from files with the same columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from fleetgauge.schemas import LOG_ROW, TOPIC_PARTITIONS
from fleetgauge.sources.segments import SegmentLog, start_positions

KAFKA = "kafka"
SEGMENTS = "segments"
EARLIEST = "earliest"
LATEST = "latest"

# Offsets below 2^48 and fewer than 2^15 partitions share one bigint.
_OFFSET_BITS = 48


def read_log(
    spark: SparkSession,
    location: str,
    fmt: str = "parquet",
    topic: str | None = None,
    streaming: bool = False,
    start: str = EARLIEST,
    keep_start: str | None = None,
    **options: str,
) -> DataFrame:
    """Rows ``key, value, topic, partition, offset, timestamp`` with text keys and values.

    ``location`` is the broker list for Kafka and a folder otherwise. A bounded read covers the whole log
    from ``start``; a stream goes on from its checkpoint and uses ``start`` only the first time. Kafka needs
    the connector on the class path. ``segments`` is a ``SegmentLog``, which can be read from any offset or time (see
    ``start_positions``); its streams need ``keep_start``, a folder beside the checkpoint, unless they start at the
    earliest. Plain files know no start but that.
    """
    if fmt == SEGMENTS:
        if streaming and start != EARLIEST and not keep_start:
            raise ValueError("a stream that does not start at the earliest offset needs keep_start")
        log = SegmentLog(spark, location, LOG_ROW)
        after = start_positions(log, start, keep_start)
        rows = log.stream(after, **options) if streaming else log.read(after)
        return rows.where(F.col("topic") == topic) if topic else rows
    reader = spark.readStream if streaming else spark.read
    if fmt == KAFKA:
        if topic is None:
            raise ValueError("a Kafka log needs a topic")
        if not streaming and start == LATEST:
            raise ValueError("a bounded read cannot start at the latest offset")
        reader = reader.format(KAFKA).options(
            **{"kafka.bootstrap.servers": location, "subscribe": topic, "startingOffsets": start, **options}
        )
        if not streaming:
            reader = reader.option("endingOffsets", LATEST)
        rows = reader.load()
        return rows.select(
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            *[c for c in LOG_ROW.names if c not in ("key", "value")],
        )
    rows = reader.format(fmt).schema(LOG_ROW).options(**options).load(location)
    return rows.where(F.col("topic") == topic) if topic else rows


def arrival_number() -> Column:
    """One integer in arrival order within each partition and unique over the log.

    A truck's readings share a partition, so for them it is the arrival order.
    """
    return F.shiftleft(F.col("partition").cast("bigint"), _OFFSET_BITS) + F.col("offset")


def partition_number_of(seq: Column | str) -> Column:
    """The partition in an arrival number."""
    seq = F.col(seq) if isinstance(seq, str) else seq
    return F.shiftright(seq, _OFFSET_BITS).cast("int")


def offset_of(seq: Column | str) -> Column:
    """The offset in an arrival number."""
    seq = F.col(seq) if isinstance(seq, str) else seq
    return seq.bitwiseAND((1 << _OFFSET_BITS) - 1)


def partition_of(key: Column | str, partitions: int = TOPIC_PARTITIONS) -> Column:
    """Partition number of a key: the same key always has the same one."""
    key = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int")


def spread_for_write(rows: DataFrame, key: str = "truck_id", partitions: int = TOPIC_PARTITIONS) -> DataFrame:
    """Rows with their ``partition``, gathered by it for a write with ``partitionBy("partition")``.

    The number and not the task is what keeps a key together: adaptive execution may let several tasks write
    one heavy partition.
    """
    numbered = rows.withColumn("partition", partition_of(key, partitions))
    return numbered if rows.isStreaming else numbered.hint("rebalance", "partition")


def write_log(rows: DataFrame, location: str, fmt: str = "parquet", topic: str | None = None) -> None:
    """Append ``(key, value)`` rows of a table."""
    writer = rows.write.mode("append").format(fmt)
    if fmt == KAFKA:
        writer.option("kafka.bootstrap.servers", location).option("topic", topic).save()
    else:
        writer.save(location)


def stream_log(
    rows: DataFrame, location: str, checkpoint: str, fmt: str = "parquet", topic: str | None = None
) -> DataStreamWriter:
    """Append-mode writer of ``(key, value)`` rows of a stream."""
    writer = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).format(fmt)
    if fmt == KAFKA:
        return writer.option("kafka.bootstrap.servers", location).option("topic", topic)
    return writer.option("path", location)
