"""Readings far from their truck's usual temperature."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.config import seconds
from fleetgauge.functions.numbers import sum_of_centi
from fleetgauge.operators.series import trailing_sums

# Readings of one truck and window that meet their statistics in one task.
BLOCK = 1 << 20
# Readings of more hundredths are scored, but aren't part of the trailing statistics, whose squares have 38 digits.
MOST_CENTI = 10**12


def _score(centi: Column, n: Column, total: Column, squares: Column) -> Column:
    """Distance from the mean in standard deviations; null without spread."""
    n, total, squares = (c.cast("double") for c in (n, total, squares))
    spread = F.when(n > 1, n * squares - total * total)
    return F.round((centi * n - total) / F.sqrt(F.nullif(spread, F.lit(0.0))), 6)


def zscore_anomalies(normalized: DataFrame, window: int = 86_400, threshold: float = 3.0, block: int = BLOCK) -> DataFrame:
    """Readings more than ``threshold`` standard deviations from the mean of their truck's readings in the
    same ``window`` seconds, with ``zscore``. Windows without spread have none.

    Count, sum and sum of squares combine inside each partition and are exact, so the statistics do not
    depend on the order of the readings. Only squares that add up to more than 38 digits are added as doubles.
    """
    timed = normalized.withColumn("_window", F.window("event_time", seconds(window)))
    centi = F.col("temperature_centi").cast("decimal(19,0)")
    square = centi * centi
    stats = timed.groupBy("truck_id", "_window").agg(
        F.count("*").alias("_n"),
        sum_of_centi("temperature_centi").alias("_sum"),
        F.coalesce(F.try_sum(square).cast("double"), F.sum(square.cast("double"))).alias("_squares"),
    )
    # A window with more than a block of readings meets its one row of statistics in a task per block. There are
    # fewer such windows than blocks in the table.
    parts = F.call_function("div", F.col("_n") + (block - 1), F.lit(block).cast("bigint"))
    stats = stats.withColumn("_parts", parts)
    large = stats.where("_parts > 1").select("truck_id", "_window", "_parts")
    salt = F.pmod(F.xxhash64("truck_id", "timestamp"), F.coalesce("_parts", F.lit(1).cast("bigint")))
    salted = stats.withColumn("_salt", F.explode(F.expr("sequence(0L, _parts - 1)"))).drop("_parts")
    spread = timed.join(large, ["truck_id", "_window"], "left").withColumn("_salt", salt)
    scored = spread.join(salted, ["truck_id", "_window", "_salt"])
    scored = scored.withColumn("zscore", _score(F.col("temperature_centi"), F.col("_n"), F.col("_sum"), F.col("_squares")))
    return scored.where(F.abs("zscore") > threshold).select(*normalized.columns, "zscore")


def trailing_zscores(normalized: DataFrame, window: int = 86_400, threshold: float = 3.0) -> DataFrame:
    """Readings more than ``threshold`` standard deviations from the mean of their truck's readings of the ``window``
    seconds up to them, both ends and readings of the same instant included, with ``zscore``. A reading alone in its
    range, or in one without spread, has none."""
    at = F.unix_micros("event_time")
    counted = F.col("temperature_centi") <= MOST_CENTI
    centi = F.when(counted, F.col("temperature_centi")).otherwise(0).cast("decimal(19,0)")
    stats = trailing_sums(
        normalized, ("truck_id",), at, window * 1_000_000,
        _n=F.when(counted, 1).otherwise(0), _sum=centi, _squares=centi * centi,
    )
    scored = normalized.withColumn("at", at).join(stats, ["truck_id", "at"])
    scored = scored.withColumn("zscore", _score(F.col("temperature_centi"), F.col("_n"), F.col("_sum"), F.col("_squares")))
    return scored.where(F.abs("zscore") > threshold).select(*normalized.columns, "zscore")
