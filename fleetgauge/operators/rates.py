"""Event rates over arrival time and counter rates over metric samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.config import seconds
from fleetgauge.functions.numbers import floor_div
from fleetgauge.operators.dedup import with_key, dedup_readings
from fleetgauge.operators.series import trailing_sums, with_previous
from fleetgauge.schemas import READING_KEY

RATE_WINDOW = 5
RATE_REFRESH = 1
HISTORY_POINTS = 60


def _per_pane(rows: DataFrame, arrival: str, length: int, **counts: Column) -> DataFrame:
    return rows.groupBy(F.window(arrival, seconds(length))).agg(
        *[expr.cast("bigint").alias(name) for name, expr in counts.items()]
    )


def stage_rates(
    readings: DataFrame,
    averages: DataFrame | None = None,
    window: int = RATE_WINDOW,
    refresh: int = RATE_REFRESH,
    arrival: str = "arrival",
    keys: tuple[str, ...] = READING_KEY,
) -> DataFrame:
    """Events per second by stage over the trailing ``window`` seconds, every ``refresh`` seconds.

    Duplicates need not be labelled one by one: of the keyed readings that arrived in a pane, those that are
    not a first arrival are duplicates. Each stage is counted per pane of ``refresh`` seconds and the few
    panes are then combined into sliding windows.
    """
    zero = F.lit(0).cast("bigint")
    filtered = F.col("temperature") <= 0
    firsts = dedup_readings(readings.select(*keys, "temperature", arrival, "seq"), keys)
    columns = ("arrived", "firsts", "filtered", "aggregates")
    parts = [
        _per_pane(with_key(readings, keys), arrival, refresh, arrived=F.count("*")),
        _per_pane(firsts, arrival, refresh, firsts=F.count("*"), filtered=F.count_if(filtered)),
    ]
    if averages is not None:
        parts.append(_per_pane(averages, "computed_at", refresh, aggregates=F.count("*")))
    panes = parts[0]
    for part in parts[1:]:
        panes = panes.unionByName(part, allowMissingColumns=True)
    panes = panes.withColumns({c: zero for c in columns if c not in panes.columns})
    sliding = panes.groupBy(F.window("window", seconds(window), seconds(refresh)).alias("over")).agg(
        *[F.coalesce(F.sum(c), zero).alias(c) for c in columns]
    )

    def rate(count: Column) -> Column:
        return F.round(count / F.lit(float(window)), 2)

    return sliding.select(
        F.col("over.end").alias("sampled_at"),
        rate(F.col("firsts") - F.col("filtered")).alias("ingestion_rate"),
        rate(F.col("filtered")).alias("filter_rate"),
        rate(F.col("arrived") - F.col("firsts")).alias("duplicate_rate"),
        rate(F.col("aggregates")).alias("aggregate_rate"),
    )


def parsed_rate(rates: DataFrame) -> DataFrame:
    """Add what is left of the ingestion rate after the filter, never below zero."""
    left = F.round(F.col("ingestion_rate") - F.col("filter_rate"), 2)
    return rates.withColumn("parsed_rate", F.greatest(F.lit(0.0), left))


def throughput_history(
    rates: DataFrame, points: int = HISTORY_POINTS, refresh: int = RATE_REFRESH
) -> DataFrame:
    """Ingestion and filter rate at the last ``points`` refreshes, newest first; zero where nothing arrived, for which
    ``rates`` has no row. The newest ``points`` rows hold all that is needed, so the grid is laid over those."""
    newest = (
        rates.select("sampled_at", F.struct("ingestion_rate", "filter_rate").alias("rate"))
        .orderBy(F.col("sampled_at").desc())
        .limit(points)
    )
    held = newest.agg(
        F.max("sampled_at").alias("_end"),
        F.map_from_entries(F.collect_list(F.struct("sampled_at", "rate"))).alias("_seen"),
    )

    def back(steps: int) -> Column:
        return F.make_dt_interval(secs=F.lit(-steps * refresh))

    instants = F.sequence(F.col("_end"), F.col("_end") + back(points - 1), back(1))
    grid = held.select(F.explode(instants).alias("sampled_at"), "_seen")
    rate = F.try_element_at("_seen", F.col("sampled_at"))
    return grid.select(
        "sampled_at",
        F.coalesce(rate["ingestion_rate"], F.lit(0.0)).alias("ingestion"),
        F.coalesce(rate["filter_rate"], F.lit(0.0)).alias("filtered"),
    )


def counter_rate(
    samples: DataFrame,
    window: int = 60,
    span: int = 3600,
    series: tuple[str, ...] = ("metric",),
) -> DataFrame:
    """Per-second increase of a counter over the trailing ``window`` seconds, both ends included, at each
    sample.

    A value below its predecessor is a restart, and counts from zero. ``samples`` are ``(series, ts, value)``,
    one per series and instant; a sample without a value, or with NaN, is passed over. A series may hold any share of the samples, so it is worked on in spans of
    time. A span is also shown the samples of the ``window`` seconds before it, and takes the predecessor of
    the first of those from one row per earlier span.
    """
    if span < window:
        raise ValueError("a span must be at least as long as the window")
    span_us, window_us = span * 1_000_000, window * 1_000_000

    def span_at(instant: Column) -> Column:
        return floor_div(instant, span_us)

    at = F.unix_micros("ts")
    own, next_shown = span_at(at), span_at(at + window_us)
    shown = (
        samples.where(F.col("value").isNotNull() & ~F.isnan("value"))
        .select(
            *series,
            "ts",
            "value",
            F.explode(
                F.when(own == next_shown, F.array(own)).otherwise(F.array(own, next_shown))
            ).alias("_span"),
        )
        .where(F.col("_span").isNotNull())
        .repartition(*series, "_span")
        .withColumn("_at", at)
    )
    # The samples that no later span is shown: the last of them precedes all that the next span sees.
    settled = F.when(span_at(F.col("_at") + window_us) == F.col("_span"), F.col("_at"))
    spans = Window.partitionBy(*series).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        shown.groupBy(*series, "_span")
        .agg(F.max_by("value", settled).alias("_last"))
        .select(*series, "_span", F.last("_last", ignorenulls=True).over(spans).alias("_carried"))
    )
    inside = Window.partitionBy(*series, "_span").orderBy("_at")
    joined = shown.withColumn("_lag", F.lag("value").over(inside)).join(before, [*series, "_span"])
    previous, value = F.coalesce("_lag", "_carried"), F.col("value")
    increase = F.when(previous.isNull(), 0.0).when(value >= previous, value - previous).otherwise(value)
    grown = joined.withColumn("_increase", increase)
    # A window is the end of one stretch of ``window`` and the beginning of the next one. Sums up to each sample in its
    # stretch, and from there to the stretch's end, cost one addition a sample, and unlike a difference of running
    # sums they have nothing in them but the window's own increases. A sample looks up where its window begins, in the
    # stretch before its own, at a place of its own that stands before a sample of the same instant.
    stretch = floor_div(F.col("_at"), window_us)
    in_stretch = Window.partitionBy(*series, "_span", "_stretch")
    so_far = F.sum("_increase").over(in_stretch.orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
    summed = grown.withColumn("_stretch", stretch).withColumn("_so_far", so_far)
    point = F.struct(F.col("_at").alias("at"), F.col("_stretch").alias("stretch"), F.lit(1).alias("kind"),
                     F.col("_increase").alias("increase"))
    look_up = F.struct((F.col("_at") - window_us).alias("at"), (F.col("_stretch") - 1).alias("stretch"),
                       F.lit(0).alias("kind"), F.lit(0.0).alias("increase"))
    placed = F.when(span_at(F.col("_at")) == F.col("_span"), F.array(point, look_up)).otherwise(F.array(point))
    places = summed.select(*series, "_span", "ts", "value", "_so_far", F.explode(placed).alias("_place")).select(
        *series, "_span", "ts", "value", "_so_far", F.col("_place.at").alias("_at"),
        F.col("_place.stretch").alias("_stretch"), F.col("_place.kind").alias("_kind"),
        F.col("_place.increase").alias("_increase"))
    to_end = in_stretch.orderBy(F.desc("_at"), F.desc("_kind")).rowsBetween(Window.unboundedPreceding, 0)
    ended = places.withColumn("_to_end", F.sum("_increase").over(to_end)).where("_kind = 0")
    return ended.select(
        *series, "ts", "value", ((F.col("_to_end") + F.col("_so_far")) / F.lit(float(window))).alias("rate")
    )


# Increases of a counter, to twelve decimals.
_INCREASE = "decimal(38,12)"


def counter_rate_by_blocks(samples: DataFrame, window: int = 60, series: tuple[str, ...] = ("metric",)) -> DataFrame:
    """What ``counter_rate`` gives, for series with any number of samples in any stretch of time.

    Samples are cut into blocks of about equally many rows, and a window's increase is the difference of two exact running
    sums: a sample costs the same however many its window covers. Increases count to twelve decimals. Without hot
    series ``counter_rate`` moves less.
    """
    known = samples.where(F.col("value").isNotNull() & ~F.isnan("value")).select(*series, "ts", "value")
    known = known.withColumn("_at", F.unix_micros("ts"))
    previous, value = F.col("previous"), F.col("value")
    increase = F.when(previous.isNull(), 0.0).when(value >= previous, value - previous).otherwise(value)
    grown = with_previous(known, series, "_at", "value").withColumn("_increase", increase.cast(_INCREASE))
    sums = trailing_sums(grown, series, F.col("_at"), window * 1_000_000, _INCREASE, _sum=F.col("_increase"))
    return grown.join(sums.withColumnRenamed("at", "_at"), [*series, "_at"]).select(
        *series, "ts", "value", (F.col("_sum").cast("double") / F.lit(float(window))).alias("rate")
    )
