"""Reports on whole tables: data-set quality, pipeline totals, consumer lag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.functions.numbers import passes_temperature_filter
from fleetgauge.operators.dedup import with_key, dedup_readings
from fleetgauge.operators.fleet import ALERT_ABOVE, ANOMALIES_KEPT
from fleetgauge.operators.validation import REQUIRED_FIELDS
from fleetgauge.schemas import READING_KEY


def dataset_quality(dataset: DataFrame) -> DataFrame:
    """One row: counts, and the verdict PASS or FAIL with its reason.

    ``valid`` counts the readings the pipeline would keep. ``valid_reported`` is the figure of the stricter
    report, which takes null temperatures off twice.
    """
    missing = sorted(set(REQUIRED_FIELDS) - set(dataset.columns))
    if missing:
        return dataset.groupBy().agg(
            F.count("*").alias("rows"),
            F.lit("FAIL").alias("verdict"),
            F.lit(f"missing columns {missing}").alias("reason"),
        )
    kept = passes_temperature_filter("temperature")
    counted = dataset.groupBy().agg(
        F.count("*").alias("rows"),
        F.count_distinct("truck_id").alias("unique_trucks"),
        F.count_if(F.col("truck_id").isNull()).alias("null_truck_id"),
        F.count_if(F.col("temperature").isNull() | F.isnan("temperature")).alias("null_temperature"),
        F.count_if(~kept).alias("not_positive"),
        F.count_if(kept).alias("valid"),
    )
    bad = (F.col("null_truck_id") > 0) | (F.col("null_temperature") > 0)
    return counted.withColumns({
        "valid_reported": F.col("rows") - F.col("not_positive") - F.col("null_temperature"),
        "verdict": F.when(bad, "FAIL").otherwise("PASS"),
        "reason": F.when(bad, "null required fields").otherwise("schema and filter rules OK"),
    })


def telemetry_totals(
    readings: DataFrame,
    averages: DataFrame | None = None,
    keys: tuple[str, ...] = READING_KEY,
    order: str = "seq",
) -> DataFrame:
    """One row of counters over raw readings: raw, no_key, duplicates, filtered, accepted, aggregates,
    active trucks, and anomalies in the buffer.

    Everything follows from one row per key, its first arrival and its number of copies, so no reading is
    labelled and none is exchanged twice.
    """
    raw = readings.groupBy().agg(F.count("*").alias("total_raw"))
    per_key = (
        with_key(readings, keys)
        .groupBy(*keys)
        .agg(F.count("*").alias("_copies"), F.min_by("temperature", order).alias("_t"))
    )
    t = F.col("_t")
    per_truck = per_key.groupBy("truck_id").agg(
        F.sum("_copies").alias("copies"),
        F.count("*").alias("firsts"),
        F.count_if(t <= 0).alias("filtered"),
        F.count_if((t > ALERT_ABOVE) & ~F.isnan(t)).alias("hot"),
    )
    zero = F.lit(0).cast("bigint")
    totals = per_truck.select("truck_id", "copies", "firsts", "filtered", "hot")
    if averages is not None:
        emitted = averages.groupBy("truck_id").agg(F.count("*").alias("aggregates"))
    else:
        emitted = totals.select("truck_id", zero.alias("aggregates"))
    # A truck is active once it has an accepted reading or an average.
    merged = totals.join(emitted, "truck_id", "full_outer").select(
        "truck_id",
        *[F.coalesce(c, zero).alias(c) for c in ("copies", "firsts", "filtered", "hot", "aggregates")],
    )
    counted = merged.agg(
        *[F.coalesce(F.sum(c), zero).alias(c) for c in ("copies", "firsts", "filtered", "hot", "aggregates")],
        F.count_if(
            F.col("truck_id").isNotNull()
            & ((F.col("firsts") > F.col("filtered")) | (F.col("aggregates") > 0))
        ).alias("active_trucks"),
    )
    # Both sides are single rows; stacking them avoids a join without a key.
    both = raw.unionByName(counted, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("total_raw", *counted.columns)]
    )
    return both.select(
        "total_raw",
        (F.col("total_raw") - F.col("copies")).alias("no_key"),
        (F.col("copies") - F.col("firsts")).alias("duplicates"),
        "filtered",
        (F.col("firsts") - F.col("filtered")).alias("accepted"),
        F.col("aggregates").alias("total_aggregates"),
        "active_trucks",
        F.col("hot").alias("anomalies_seen"),
        F.least(F.col("hot"), F.lit(ANOMALIES_KEPT).cast("bigint")).alias("anomalies"),
    )


def consumer_lag(offsets: DataFrame, group_known: bool = True) -> DataFrame:
    """Lag by topic, and in total on the row whose topic is null, from ``(topic, partition, high, committed)``.

    A missing or negative committed offset is no lag. An unknown group without lag is ``down``, and then has
    no total.
    """
    committed = F.when(F.col("committed") >= 0, F.col("committed")).otherwise(F.col("high"))
    behind = offsets.withColumn("_behind", F.greatest(F.lit(0).cast("bigint"), F.col("high") - committed))
    lags = behind.rollup("topic").agg(
        F.coalesce(F.sum("_behind"), F.lit(0).cast("bigint")).alias("lag"),
        F.grouping("topic").alias("_total"),
    )
    down = F.lit(not group_known) & (F.col("_total") == 1) & (F.col("lag") == 0)
    return lags.select(
        "topic",
        F.when(~down, F.col("lag")).alias("lag"),
        F.when(F.col("_total") == 1, F.when(down, "down").otherwise("ok")).alias("status"),
    )
