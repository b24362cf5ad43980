"""Running state per truck, its changelog, and recovery from it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.functions.numbers import average_of, centi_of_sum, floor_div, from_centi, sum_of_centi
from fleetgauge.functions.payloads import state_key, truck_of_key
from fleetgauge.functions.times import instant
from fleetgauge.operators.windows import partial_sums

# Arrival numbers per block of the running sums. ``seq`` is unique, so a block holds at most this many rows.
BLOCK = 1 << 20


def running_state(
    normalized: DataFrame,
    keys: tuple[str, ...] = ("truck_id",),
    order: str = "seq",
    block: int = BLOCK,
) -> DataFrame:
    """After each reading, the truck's cumulative ``(sum, count, average)`` in arrival order.

    One truck may own any share of the readings, so its series is not sorted in one task: it is cut into
    blocks of arrival numbers, each block gets the total of the blocks before it (from one row per block),
    and the running sum is taken inside the block.
    """
    block_number = floor_div(F.col(order), block)
    # One exchange serves both branches below. To share it they must read the same columns, which is why
    # blocks are put in order by their first arrival, and the same rows, which is why the null check that the
    # join would add to one of them stands here.
    blocked = (
        normalized.select(*keys, order, "temperature_centi", block_number.alias("_block"))
        .where(F.col("_block").isNotNull())
        .repartition(*keys, "_block")
    )
    earlier = Window.partitionBy(*keys).orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    carried = (
        blocked.groupBy(*keys, "_block")
        .agg(
            F.min(order).alias("_first"),
            sum_of_centi("temperature_centi").alias("_sum"),
            F.count("temperature_centi").alias("_count"),
        )
        .select(
            *keys,
            "_block",
            F.coalesce(F.sum("_sum").over(earlier), zero).alias("_sum_before"),
            F.coalesce(F.sum("_count").over(earlier), zero).alias("_count_before"),
        )
    )
    so_far = (
        Window.partitionBy(*keys, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    )
    inside = blocked.select(
        *keys,
        "_block",
        order,
        sum_of_centi("temperature_centi").over(so_far).alias("_sum"),
        F.count("temperature_centi").over(so_far).alias("_count"),
    )
    total = F.col("_sum_before") + F.col("_sum")
    count = F.col("_count_before") + F.col("_count")
    return inside.join(carried, [*keys, "_block"]).select(
        *keys,
        order,
        from_centi(total).alias("sum"),
        count.alias("count"),
        average_of(total, count).alias("average"),
    )


def truck_totals(normalized: DataFrame, keys: tuple[str, ...] = ("truck_id",)) -> DataFrame:
    """All-time ``(sum, count, average)`` per truck. On a stream in update mode: the changed trucks."""
    return partial_sums(normalized, *keys).select(
        *keys,
        from_centi("centi_sum").alias("sum"),
        F.col("reading_count").alias("count"),
        average_of("centi_sum", "reading_count").alias("average"),
    )


def state_of(wanted: DataFrame, states: DataFrame) -> DataFrame:
    """State of each wanted truck; one that was never seen has the empty state."""
    return wanted.join(states, "truck_id", "left").select(
        *wanted.columns,
        F.coalesce("sum", F.lit(0.0)).alias("sum"),
        F.coalesce("count", F.lit(0).cast("bigint")).alias("count"),
        F.coalesce("average", F.lit(0.0)).alias("average"),
    )


def changelog_of(states: DataFrame, order: str = "seq") -> DataFrame:
    """Upserts ``(key, value, seq)`` of running states."""
    return states.select(
        state_key("truck_id").alias("key"), F.struct("sum", "count").alias("value"), order
    )


def compact_changelog(changelog: DataFrame, order: str = "seq") -> DataFrame:
    """The last entry of each key, deletions included. It replays to the same state as the whole log, in time
    that follows the number of trucks and not of readings."""
    last = changelog.groupBy("key").agg(
        F.max(order).alias(order),
        F.max_by(F.col("value").isNotNull(), order).alias("_written"),
        F.max_by("value.sum", order).alias("sum"),
        F.max_by("value.count", order).alias("count"),
    )
    return last.select("key", F.when(F.col("_written"), F.struct("sum", "count")).alias("value"), order)


def materialize_changelog(changelog: DataFrame, order: str = "seq") -> DataFrame:
    """Live state ``(truck_id, sum, count, average)``: the last write of each key, unless it was a null
    value, which deletes. Replaying a log twice gives the same state."""
    live = compact_changelog(changelog, order).where(F.col("value").isNotNull()).select(
        truck_of_key("key").alias("truck_id"),
        F.coalesce("value.sum", F.lit(0.0)).alias("sum"),
        F.coalesce("value.count", F.lit(0).cast("bigint")).alias("count"),
    )
    return live.withColumn("average", average_of(centi_of_sum("sum"), "count"))


def state_as_of(changelog: DataFrame, position: int | Column, order: str = "seq") -> DataFrame:
    """Live state as it was after the log entry at ``position``, for a log of one partition or a table with one order
    over all its entries. Positions of several partitions can't be compared: use one of the two forms below."""
    return materialize_changelog(changelog.where(F.col(order) <= position), order)


def state_as_of_time(
    changelog: DataFrame, moment: datetime | Column, arrival: str = "timestamp", order: str = "seq"
) -> DataFrame:
    """Live state of what had arrived at ``moment``, that instant included, over any number of partitions."""
    at = instant(moment) if isinstance(moment, datetime) else moment
    return materialize_changelog(changelog.where(F.col(arrival) <= at), order)


def state_as_of_offsets(changelog: DataFrame, offsets: DataFrame, order: str = "seq") -> DataFrame:
    """Live state after the entry at ``offset`` of each ``partition`` in ``offsets``; of a partition that is not
    there nothing has been read."""
    until = offsets.select("partition", F.col("offset").alias("_until"))
    read = changelog.join(until, "partition").where(F.col("offset") <= F.col("_until"))
    return materialize_changelog(read, order)


def reconcile_states(expected: DataFrame, recovered: DataFrame, report_extra: bool = False) -> DataFrame:
    """Expected against recovered state by truck, with ``matches``.

    A truck that was not recovered counts as the empty state. Trucks that were recovered but not expected are
    passed over unless ``report_extra`` asks for them.
    """
    zero, none = F.lit(0.0), F.lit(0).cast("bigint")
    exp = expected.select(
        "truck_id", F.col("sum").alias("expected_sum"), F.col("count").alias("expected_count")
    )
    rec = recovered.select(
        "truck_id", F.col("sum").alias("_sum"), F.col("count").alias("_count")
    )
    both = exp.join(rec, "truck_id", "full_outer" if report_extra else "left")
    recovered_sum, recovered_count = F.coalesce("_sum", zero), F.coalesce("_count", none)
    return both.select(
        "truck_id",
        "expected_sum",
        "expected_count",
        recovered_sum.alias("recovered_sum"),
        recovered_count.alias("recovered_count"),
        (
            F.col("expected_sum").eqNullSafe(recovered_sum)
            & F.col("expected_count").eqNullSafe(recovered_count)
        ).alias("matches"),
    )
