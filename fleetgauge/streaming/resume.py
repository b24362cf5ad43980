"""A running state that goes on from its changelog when its checkpoint is lost.

Each micro-batch of ``start_logged_state`` commits the trucks that changed to the changelog, with the position of the last
reading that each counts. From these a new query with an empty checkpoint learns three things, which it keeps beside
the checkpoint: the state so far, from the compacted changelog; the position to read on from; and the keys of the
readings before it, whose copies may still come. Its own sums start at nothing, and every micro-batch adds the state so
far to them.
"""

from __future__ import annotations

from datetime import timedelta
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fleetgauge.functions.numbers import centi_of_sum, from_centi, sum_of_centi
from fleetgauge.functions.payloads import decode, state_key, truck_of_key
from fleetgauge.operators.dedup import dedup_readings
from fleetgauge.operators.normalize import normalize, with_event_time
from fleetgauge.schemas import CHANGELOG_TOPIC, READING_KEY, STATE_VALUE
from fleetgauge.sources.logs import offset_of, partition_number_of, partition_of
from fleetgauge.sources.segments import Positions, SegmentLog
from fleetgauge.sources.telemetry import decode_readings
from fleetgauge.streaming.queries import STATE_DELAY, run

# What a record of this changelog says, the position of the last reading beside the state.
LOGGED_VALUE = T.StructType([*STATE_VALUE.fields, T.StructField("upto", T.LongType())])
_HELD = "truck_id bigint, held_sum double, held_count bigint, held_upto bigint"


class Base(NamedTuple):
    """``state``: ``truck_id, held_sum, held_count, held_upto``; ``keys``: of readings before ``positions``; ``batches``: how
    many the changelog had."""

    state: DataFrame
    keys: DataFrame
    positions: Positions
    batches: int


def logged_state(changelog: SegmentLog) -> DataFrame:
    """The last record of each truck in the changelog: ``truck_id, held_sum, held_count, held_upto``."""
    value = decode("value", LOGGED_VALUE)
    last = changelog.read().groupBy("key").agg(F.max_by("value", "offset").alias("value"))
    return last.where(F.col("value").isNotNull()).select(
        truck_of_key("key").alias("truck_id"), value["sum"].alias("held_sum"), value["count"].alias("held_count"),
        value["upto"].alias("held_upto"),
    )


def bootstrap(readings: SegmentLog, changelog: SegmentLog, location: str, horizon: timedelta | None = None) -> Base:
    """The base of a query whose checkpoint is empty, kept below ``location`` and found there again at a restart.

    ``horizon`` is how far before the newest reading a copy may still come from: keys of readings that arrived
    earlier aren't kept. Without it all are.
    """
    spark = changelog.spark
    schema = "partition int, offset bigint, batches bigint"
    try:
        found = spark.read.schema(schema).parquet(f"{location}/positions").collect()
    except AnalysisException:
        found = None
    if not found:
        logged_state(changelog).write.mode("overwrite").parquet(f"{location}/state")
        state = spark.read.schema(_HELD).parquet(f"{location}/state")
        ends = state.groupBy(partition_number_of("held_upto").alias("partition")).agg(
            F.max(offset_of("held_upto")).alias("offset"))
        positions = {r.partition: r.offset for r in ends.collect()}
        since = None
        if horizon is not None:
            newest = readings.index().agg(F.max("last_time")).first()[0]
            since = newest - horizon if newest else None
        earlier = decode_readings(readings.read(until=positions, since=since))
        earlier.select(*READING_KEY).distinct().write.mode("overwrite").parquet(f"{location}/keys")
        # Written last: with it, the base is complete. A row without a partition stands for a changelog without records.
        batches = max(changelog.batches(), default=-1) + 1
        rows = [(p, o, batches) for p, o in positions.items()] or [(None, None, batches)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{location}/positions")
        found = spark.read.schema(schema).parquet(f"{location}/positions").collect()
    keys = spark.read.schema("truck_id bigint, timestamp string").parquet(f"{location}/keys")
    state = spark.read.schema(_HELD).parquet(f"{location}/state")
    return Base(state, keys, {r.partition: r.offset for r in found if r.partition is not None}, found[0].batches)


def new_totals(readings: DataFrame, base: Base, delay: str) -> DataFrame:
    """Sums of the readings that neither the base nor the stream has counted, by truck."""
    fresh = with_event_time(readings).join(base.keys, list(READING_KEY), "left_anti")
    counted = normalize(dedup_readings(fresh, delay=delay, at_once=True))
    return counted.groupBy("truck_id").agg(
        sum_of_centi("temperature_centi").alias("centi"), F.count("temperature_centi").alias("n"), F.max("seq").alias("upto"))


def start_logged_state(
    readings: SegmentLog,
    changelog: SegmentLog,
    checkpoint: str,
    delay: str = STATE_DELAY,
    horizon: timedelta | None = None,
    every: str | None = None,
    **options: str,
) -> StreamingQuery:
    """Keep the state of the readings in the changelog, going on from what is there.

    With its checkpoint the query goes on from that. With an empty one it starts from the changelog. Both times
    every micro-batch is committed under a number of its own, so that one that runs again changes nothing.
    """
    base = bootstrap(readings, changelog, f"{checkpoint}-base", horizon)
    stream = decode_readings(readings.stream(after=base.positions, **options))

    def commit(changed: DataFrame, batch: int) -> None:
        both = changed.join(base.state, "truck_id", "left")
        none = F.lit(0).cast("bigint")
        total = F.col("centi") + F.coalesce(centi_of_sum("held_sum"), none)
        value = F.struct(
            from_centi(total).alias("sum"),
            (F.col("n") + F.coalesce("held_count", none)).alias("count"),
            F.greatest("upto", "held_upto").alias("upto"),
        )
        number = base.batches + batch
        key = state_key("truck_id")
        changelog.append(
            both.select(
                key.alias("key"), F.to_json(value).alias("value"), F.lit(CHANGELOG_TOPIC).alias("topic"),
                partition_of(key).alias("partition"), F.lit(number).cast("bigint").alias("offset"),
                F.current_timestamp().alias("timestamp"),
            ),
            number,
        )

    writer = new_totals(stream, base, delay).writeStream.outputMode("update")
    return run(writer.option("checkpointLocation", checkpoint).foreachBatch(commit), every=every)
