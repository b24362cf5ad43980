"""Alerts on conditions that hold for a while."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import astuple, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetgauge.functions.numbers import floor_div
from fleetgauge.operators.series import runs


@dataclass(frozen=True)
class AlertRule:
    """Fires once ``metric`` compares true with ``threshold`` for ``hold`` seconds."""

    alert: str
    metric: str
    comparison: str
    threshold: float
    hold: int
    severity: str


# The rules the dashboard ships with.
FLEET_RULES = (
    AlertRule("KafkaDown", "kafka_connected", "==", 0.0, 60, "warning"),
    AlertRule("NoWorkers", "workers_running", "==", 0.0, 120, "warning"),
    AlertRule("HighAnomalies", "anomalies", ">", 20.0, 120, "info"),
)

# So many rules, of a few hundred bytes each, are sent to all tasks; more are joined by a shuffle.
BROADCAST_RULES = 10_000

_RULE_COLUMNS = "alert string, metric string, comparison string, threshold double, hold int, severity string"


def _rule_table(spark: SparkSession, rules: tuple[AlertRule, ...]) -> DataFrame:
    """The rules as a table, marked for broadcast if they are few."""
    table = spark.createDataFrame([astuple(r) for r in rules], _RULE_COLUMNS)
    return F.broadcast(table) if len(rules) <= BROADCAST_RULES else table


def _holds() -> Column:
    value, threshold, comparison = F.col("value"), F.col("threshold"), F.col("comparison")
    compared = (
        F.when(comparison == "==", value == threshold)
        .when(comparison == "!=", value != threshold)
        .when(comparison == ">", value > threshold)
        .when(comparison == ">=", value >= threshold)
        .when(comparison == "<", value < threshold)
        .when(comparison == "<=", value <= threshold)
    )
    # NaN compares false with everything but "!=".
    usable = value.isNotNull() & (~F.isnan(value) | (comparison == "!="))
    return F.coalesce(compared & usable, F.lit(False))


def sustained_alerts(
    samples: DataFrame,
    rules: Iterable[AlertRule] = FLEET_RULES,
    span: int = 3600,
) -> DataFrame:
    """State of every rule at every sample ``(metric, ts, value)`` of its metric: inactive, pending, or firing
    once the condition has held without a break for the rule's time. ``active_since`` is the start of the
    current run.

    A series may hold any share of the samples, so runs are found in spans of time. One row per span tells
    whether the condition broke and when the run that leaves the span began; that gives the run each span
    enters with.
    """
    table = _rule_table(samples.sparkSession, tuple(rules))
    number = floor_div(F.unix_micros("ts"), span * 1_000_000)
    # One exchange of the samples serves both uses below; the conditions are judged behind it. The null check
    # is the one a join would otherwise add to one use, which would then need an exchange of its own.
    cut = (
        samples.join(table.select("alert", "metric"), "metric")
        .select("alert", "ts", "value", number.alias("_span"))
        .where(F.col("_span").isNotNull())
        .repartition("alert", "_span")
    )
    judged = cut.join(table, "alert").withColumn("_active", _holds())

    inside = Window.partitionBy("alert", "_span").orderBy("ts")
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    active = F.col("_active")
    starts = F.when(active & ~F.coalesce(F.lag("_active").over(inside), F.lit(False)), F.col("ts"))
    followed = judged.withColumn("_start", starts).withColumns({
        "_began": F.when(active, F.last("_start", ignorenulls=True).over(so_far)),
        "_breaks": F.count(F.when(~active, 1)).over(so_far),
    })

    summary = followed.groupBy("alert", "_span").agg(
        F.max_by("_began", "ts").alias("_tail"), F.max("_breaks").alias("_breaks")
    )
    spans = Window.partitionBy("alert").orderBy("_span")
    broken = F.count(F.when(F.col("_breaks") > 0, 1))
    episodes = summary.withColumn(
        "_episode", broken.over(spans.rowsBetween(Window.unboundedPreceding, 0))
    )
    in_episode = Window.partitionBy("alert", "_episode").orderBy("_span")
    leaving = episodes.withColumn(
        "_leaves_with", F.min("_tail").over(in_episode.rowsBetween(Window.unboundedPreceding, 0))
    )
    entering = leaving.select("alert", "_span", F.lag("_leaves_with").over(spans).alias("_entered_with"))

    # Before the first break of a span, an active sample belongs to the run that came in, if one did.
    since = F.when(
        active & (F.col("_breaks") == 0), F.coalesce("_entered_with", "_began")
    ).otherwise(F.col("_began"))
    joined = followed.join(entering, ["alert", "_span"]).withColumn("active_since", since)
    held = F.unix_micros("ts") - F.unix_micros("active_since") >= F.col("hold").cast("bigint") * 1_000_000
    state = F.when(F.col("active_since").isNull(), "inactive").when(held, "firing").otherwise("pending")
    return joined.select("alert", "severity", "metric", "ts", "value", "active_since", state.alias("state"))


def sustained_alerts_by_blocks(samples: DataFrame, rules: Iterable[AlertRule] = FLEET_RULES) -> DataFrame:
    """What ``sustained_alerts`` gives, for series with any number of samples in any stretch of time: they are cut into
    blocks of about equally many rows, and what a block says of the run that leaves it is one row."""
    table = _rule_table(samples.sparkSession, tuple(rules))
    judged = samples.join(table, "metric").withColumn("_active", _holds())
    followed = runs(judged.select("alert", "ts", "value", "_active"), ("alert",), "ts", "_active")
    since = F.col("since")
    joined = followed.join(table, "alert")
    held = F.unix_micros("ts") - F.unix_micros(since) >= F.col("hold").cast("bigint") * 1_000_000
    state = F.when(since.isNull(), "inactive").when(held, "firing").otherwise("pending")
    return joined.select("alert", "severity", "metric", "ts", "value", since.alias("active_since"), state.alias("state"))


def current_alerts(states: DataFrame) -> DataFrame:
    """The state of each rule at the latest sample."""
    return states.groupBy("alert", "metric", "severity").agg(
        F.max("ts").alias("ts"),
        F.max_by("state", "ts").alias("state"),
        F.max_by("active_since", "ts").alias("active_since"),
    )
