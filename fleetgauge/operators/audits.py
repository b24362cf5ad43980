"""Audits: exactly-once counting, throughput, averages. That of recovery is in ``operators.recovery``."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.config import DEFAULT_WINDOWS, WindowConfig, seconds
from fleetgauge.functions.numbers import average_of
from fleetgauge.operators.windows import HOPPING, TUMBLING, partial_sums
from fleetgauge.functions.times import instant
from fleetgauge.schemas import READING_KEY

# Fixed value: the throughput target in events per second.
TARGET_EVENTS_PER_SECOND = 100_000


def exactly_once_audit(
    averages: DataFrame,
    sent: DataFrame,
    cutoff: datetime | None = None,
    keys: tuple[str, ...] = READING_KEY,
) -> DataFrame:
    """Readings counted by tumbling windows that start before ``cutoff`` against distinct readings sent:
    PASSED when equal, FAILED when doubled, INCONCLUSIVE otherwise."""
    real = averages.where(F.col("window_type") == TUMBLING)
    if cutoff is not None:
        real = real.where(F.col("window_start") < instant(cutoff))
    counted = real.groupBy().agg(F.coalesce(F.sum("reading_count"), F.lit(0).cast("bigint")).alias("counted"))
    # Copies collapse per key before the count; a key may have any number of them.
    distinct = sent.groupBy(*keys).agg(F.count("*").alias("_copies")).groupBy().agg(
        F.count("*").alias("distinct_sent"),
        F.coalesce(F.sum("_copies"), F.lit(0).cast("bigint")).alias("total_sent"),
    )
    both = counted.unionByName(distinct, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("counted", "distinct_sent", "total_sent")]
    )
    c, d = F.col("counted"), F.col("distinct_sent")
    verdict = F.when(c == d, "PASSED").when(c == 2 * d, "FAILED").otherwise("INCONCLUSIVE")
    return both.withColumn("verdict", verdict)


def throughput_audit(
    events: DataFrame, at: str = "arrival", target: float = TARGET_EVENTS_PER_SECOND
) -> DataFrame:
    """Events over the time between the first and the last, against the target."""
    spanned = events.agg(
        F.count("*").alias("events"),
        ((F.unix_micros(F.max(at)) - F.unix_micros(F.min(at))) / 1e6).alias("elapsed_seconds"),
    )
    rate = F.col("events") / F.nullif(F.col("elapsed_seconds"), F.lit(0.0))
    return spanned.withColumn("events_per_second", F.round(rate, 4)).withColumn(
        "verdict", F.when(rate >= target, "PASS").otherwise("BELOW TARGET")
    )


def average_audit(
    averages: DataFrame, normalized: DataFrame, config: WindowConfig = DEFAULT_WINDOWS
) -> DataFrame:
    """Emitted averages against means recomputed from the readings window by window, as
    ``(window_type, windows, missing, unexpected, different)``.

    The recomputation goes directly from readings to windows; it shares no pane with the audited path.
    """
    key = ["truck_id", "window_type", "window_start"]
    hop = F.window("event_time", seconds(config.size), seconds(config.step))
    whole = F.window("event_time", seconds(config.size))
    recomputed = [
        partial_sums(normalized, "truck_id", over).select(
            "truck_id",
            F.lit(kind).alias("window_type"),
            F.col("window.start").alias("window_start"),
            average_of("centi_sum", "reading_count").alias("_average"),
            F.col("reading_count").alias("_count"),
        )
        for kind, over in ((TUMBLING, whole), (HOPPING, hop))
    ]
    expected = recomputed[0].unionByName(recomputed[1])
    both = averages.select(*key, "average_temperature", "reading_count").join(expected, key, "full_outer")
    emitted, computed = F.col("reading_count").isNotNull(), F.col("_count").isNotNull()
    same = (F.col("average_temperature") == F.col("_average")) & (F.col("reading_count") == F.col("_count"))
    return both.groupBy("window_type").agg(
        F.count_if(computed).alias("windows"),
        F.count_if(computed & ~emitted).alias("missing"),
        F.count_if(emitted & ~computed).alias("unexpected"),
        F.count_if(emitted & computed & ~same).alias("different"),
    )
