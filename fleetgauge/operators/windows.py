"""Per-truck averages over event-time windows, the same code for tables and streams.

Readings are first summed into panes one hop long and panes are then combined into windows, so a reading is
exchanged once and not once per window that covers it. A tumbling window is the hopping window that starts on
a multiple of the size, so both kinds come out of one aggregation. Both shortcuts need the size to be a whole
number of hops; other settings go the direct way.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.config import DEFAULT_WINDOWS, WindowConfig, seconds
from fleetgauge.functions.numbers import average_of, sum_of_centi
from fleetgauge.functions.times import instant, iso_utc

TUMBLING = "tumbling"
HOPPING = "hopping"


def partial_sums(normalized: DataFrame, *keys: Column | str) -> DataFrame:
    """``(centi_sum, reading_count)`` per key: the mergeable state behind every average."""
    return normalized.groupBy(*keys).agg(
        sum_of_centi("temperature_centi").alias("centi_sum"),
        F.count("temperature_centi").alias("reading_count"),
    )


def merge_partials(partials: DataFrame, *keys: Column | str) -> DataFrame:
    """Collapse partial sums that share a key; null partials count for nothing."""
    return partials.groupBy(*keys).agg(
        F.coalesce(F.sum("centi_sum"), F.lit(0).cast("bigint")).alias("centi_sum"),
        F.coalesce(F.sum("reading_count"), F.lit(0).cast("bigint")).alias("reading_count"),
    )


def pane_sums(normalized: DataFrame, length: int, keys: tuple[str, ...] = ("truck_id",)) -> DataFrame:
    """Partial sums per truck and consecutive pane of ``length`` seconds, as ``(keys, window, ...)``."""
    return partial_sums(normalized, *keys, F.window("event_time", seconds(length)))


def roll_up(
    panes: DataFrame, size: int, step: int | None = None, keys: tuple[str, ...] = ("truck_id",)
) -> DataFrame:
    """Partial sums of windows of ``size`` seconds every ``step``, from panes that divide both."""
    wide = F.window("window", seconds(size), seconds(step or size))
    return panes.groupBy(*keys, wide).agg(
        F.sum("centi_sum").alias("centi_sum"), F.sum("reading_count").alias("reading_count")
    )


def tumbling_sums(normalized: DataFrame, config: WindowConfig, keys: tuple[str, ...]) -> DataFrame:
    return pane_sums(normalized, config.size, keys)


def hopping_sums(normalized: DataFrame, config: WindowConfig, keys: tuple[str, ...]) -> DataFrame:
    if config.shares_panes:
        return roll_up(pane_sums(normalized, config.step, keys), config.size, config.step, keys)
    return partial_sums(
        normalized, *keys, F.window("event_time", seconds(config.size), seconds(config.step))
    )


def build_window_average(
    sums: DataFrame,
    window_type: Column | str,
    computed_at: datetime | None = None,
    keys: tuple[str, ...] = ("truck_id",),
) -> DataFrame:
    """Result rows from ``(keys, window, centi_sum, reading_count)``; a window that counted nothing gives none."""
    kind = F.lit(window_type) if isinstance(window_type, str) else window_type
    now = instant(computed_at) if computed_at else F.current_timestamp()
    return sums.where(F.col("reading_count") > 0).select(
        *keys,
        kind.alias("window_type"),
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        average_of("centi_sum", "reading_count").alias("average_temperature"),
        "reading_count",
        now.alias("computed_at"),
    )


def tumbling_average(
    normalized: DataFrame,
    config: WindowConfig = DEFAULT_WINDOWS,
    computed_at: datetime | None = None,
    keys: tuple[str, ...] = ("truck_id",),
) -> DataFrame:
    """Averages over consecutive windows ``[start, start + size)`` aligned to the epoch."""
    return build_window_average(tumbling_sums(normalized, config, keys), TUMBLING, computed_at, keys)


def hopping_average(
    normalized: DataFrame,
    config: WindowConfig = DEFAULT_WINDOWS,
    computed_at: datetime | None = None,
    keys: tuple[str, ...] = ("truck_id",),
) -> DataFrame:
    """Averages over windows of ``size`` seconds starting every ``step``; each reading counts once in every
    window that covers it."""
    return build_window_average(hopping_sums(normalized, config, keys), HOPPING, computed_at, keys)


def window_averages(
    normalized: DataFrame,
    config: WindowConfig = DEFAULT_WINDOWS,
    computed_at: datetime | None = None,
    keys: tuple[str, ...] = ("truck_id",),
) -> DataFrame:
    """Tumbling and hopping averages in one table, told apart by ``window_type``."""
    if not config.shares_panes:
        return tumbling_average(normalized, config, computed_at, keys).unionByName(
            hopping_average(normalized, config, computed_at, keys)
        )
    return averages_of_panes(pane_sums(normalized, config.pane, keys), config, computed_at, keys)


def averages_of_panes(
    panes: DataFrame,
    config: WindowConfig = DEFAULT_WINDOWS,
    computed_at: datetime | None = None,
    keys: tuple[str, ...] = ("truck_id",),
) -> DataFrame:
    """The same averages from partial sums of panes that divide size and hop (``config.pane``)."""
    sums = roll_up(panes, config.size, config.step, keys)
    if not config.shares_panes:
        return build_window_average(roll_up(panes, config.size, keys=keys), TUMBLING, computed_at, keys).unionByName(
            build_window_average(sums, HOPPING, computed_at, keys)
        )
    size_us = config.size * 1_000_000
    on_size = F.unix_micros("window.start") % size_us == 0
    kinds = F.when(on_size, F.array(F.lit(TUMBLING), F.lit(HOPPING))).otherwise(F.array(F.lit(HOPPING)))
    # Averages are computed once a window, before a tumbling one becomes two rows.
    averages = build_window_average(sums, kinds, computed_at, keys)
    return averages.withColumn("window_type", F.explode("window_type"))


def window_bounds_iso(averages: DataFrame) -> DataFrame:
    """Bounds and computation time as UTC text, the wire form."""
    return averages.withColumns(
        {c: iso_utc(c) for c in ("window_start", "window_end", "computed_at") if c in averages.columns}
    )


def expected_average(series: DataFrame, value: str, *keys: str) -> DataFrame:
    """Offline mean of a series, to four decimals, as ``(keys, expected_average)``.

    Without keys the mean of an empty series is an error, raised when the result is computed.
    """
    exact = F.col(value).cast("decimal(28,10)")
    mean = F.round(F.avg(exact), 4).cast("double")
    if not keys:
        mean = F.when(
            F.count(value) == 0, F.raise_error(F.lit("cannot compute the average of an empty series"))
        ).otherwise(mean)
    return series.groupBy(*keys).agg(mean.alias("expected_average"))
