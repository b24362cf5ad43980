"""Redelivered readings.

``seq`` is the arrival order: an integer unique over the readings (see ``sources.telemetry``). Copies of one
reading may be any share of the table, so nothing here gathers them: batch forms reduce each key to its first
arrival inside every input partition before anything is exchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.schemas import READING_KEY

NO_KEY = "no_key"
DUPLICATE = "duplicate"
FILTERED = "filtered"
ACCEPTED = "accepted"


def with_key(readings: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    for key in keys:
        readings = readings.where(F.col(key).isNotNull())
    return readings


def dedup_readings(
    readings: DataFrame,
    keys: tuple[str, ...] = READING_KEY,
    order: str = "seq",
    delay: str = "600 seconds",
    at_once: bool = False,
    clock: DataFrame | None = None,
) -> DataFrame:
    """The first arrival of each key; readings without a key are dropped.

    On a stream, which needs an ``event_time``, a reading is given out when the watermark, ``delay`` behind
    the newest event time, has passed it, and a copy that comes later than that is dropped as late. Until
    then only the first arrival is kept, so the result is that of a table. With ``at_once`` a reading is given
    out when it arrives and its key is remembered for ``delay``; then the first one wins as long as a key's
    copies come through one input partition, as they do from a source keyed by truck.

    ``clock`` is a stream of marker rows (see ``streaming.clock``) that have an ``event_time`` and nothing else: they
    join the readings before the watermark, which they advance, and are never given out.
    """
    keyed = with_key(readings, keys)
    if readings.isStreaming:
        timed = F.col("event_time").isNotNull()
        if at_once:
            if clock is not None:
                raise ValueError("markers are for results that wait for the watermark")
            return keyed.where(timed).withWatermark("event_time", delay).dropDuplicatesWithinWatermark(list(keys))
        if clock is not None:
            keyed = keyed.unionByName(clock.select("event_time"), allowMissingColumns=True)
        # Behind the watermark, which it can't be pushed below: in front of it the filter would parse each text once more.
        # Rows without an event time don't move the watermark.
        keyed = keyed.withWatermark("event_time", delay).where(timed)
        # The watermark column has to be in the key; it follows from the timestamp text.
        groups = (*keys, "event_time")
    else:
        groups = keys

    # One min_by per column instead of one over a struct: fixed-width buffers keep the aggregate hash-based,
    # and columns nobody reads are pruned. In a table event_time, which follows from the key so that any
    # copy's will do, is carried as a result and not as a grouping column: filters on it, and with them a
    # second parse of the text, could otherwise be pushed below the aggregate.
    rest = [c for c in readings.columns if c not in (*groups, order)]
    if readings.isStreaming and clock is not None:
        # Markers have no keys and no arrival number. A filter on a grouping column would be pushed below the watermark,
        # where the markers would advance nothing; given out as aggregates, keys can only be filtered here.
        own = [F.col(k).alias(f"_{k}") for k in keys]
        firsts = keyed.groupBy(*own, "event_time").agg(
            *[F.min(k).alias(k) for k in keys],
            F.min(order).alias(order),
            *[F.min_by(c, order).alias(c) for c in rest],
        ).where(F.col(order).isNotNull())
        return firsts.select(*readings.columns)
    firsts = keyed.groupBy(*groups).agg(
        F.min(order).alias(order),
        *[(F.min(c) if c == "event_time" else F.min_by(c, order)).alias(c) for c in rest],
    )
    return firsts.select(*readings.columns)


def split_stages(
    readings: DataFrame,
    keys: tuple[str, ...] = READING_KEY,
    order: str = "seq",
) -> DataFrame:
    """Every raw reading with its ``stage``: no_key, duplicate, filtered (at or below zero) or accepted.
    A null temperature is accepted and the timestamp is not parsed.

    The first arrivals are matched back by ``seq``, which is unique, so the join is even however many copies
    a key has.
    """
    firsts = (
        with_key(readings, keys)
        .groupBy(*keys)
        .agg(F.min(order).alias(order))
        .select(order, F.lit(True).alias("_first"))
    )
    has_key = F.lit(True)
    for key in keys:
        has_key = has_key & F.col(key).isNotNull()
    stage = (
        F.when(~has_key, NO_KEY)
        .when(F.col("_first").isNull(), DUPLICATE)
        .when(F.col("temperature") <= 0, FILTERED)
        .otherwise(ACCEPTED)
    )
    return readings.join(firsts, order, "left").select(*readings.columns, stage.alias("stage"))


def accepted_readings(
    readings: DataFrame,
    keys: tuple[str, ...] = READING_KEY,
    order: str = "seq",
) -> DataFrame:
    """The ``accepted`` rows of ``split_stages`` without labelling the others: one exchange, no join."""
    return dedup_readings(readings, keys, order).where(
        F.col("temperature").isNull() | ~(F.col("temperature") <= 0)
    )
