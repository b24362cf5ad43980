"""Open windows of a stream, kept as files beside its position.

    CHECKPOINT/windows/delta-N/              the readings that the duplicate filter gave out in batch N
    CHECKPOINT/windows/base-N-WATERMARK/     sums, by pane, of the readings up to batch N that have windows open at WATERMARK

A reading is given out once, behind the watermark, and belongs to windows that end later. So a batch appends what it is
given, and only one whose watermark passes the end of a window reads the sums, gives out the windows that are closed and
leaves a new base. Closed windows never enter a state store: a batch that spans a month costs what the same readings
cost in a table. What a batch makes depends on folders of earlier batches and on what it is given, so that it can run again.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.config import WindowConfig, seconds
from fleetgauge.operators.windows import averages_of_panes, merge_partials, pane_sums
from fleetgauge.session import children, remove, small_text

# What the duplicate filter hands on.
GIVEN = "truck_id bigint, event_time timestamp, temperature_centi bigint"
_HELD = "truck_id bigint, event_time timestamp, centi_sum decimal(38,0), reading_count bigint"


class Base(NamedTuple):
    batch: int
    watermark: int


def watermark_of_batch(spark: SparkSession, checkpoint: str, batch: int) -> int:
    """The watermark in milliseconds that a batch works with, from the record that is written before it runs."""
    lines = small_text(spark, f"{checkpoint}/offsets/{batch}").splitlines()
    return next(json.loads(line)["batchWatermarkMs"] for line in lines if '"batchWatermarkMs"' in line)


class OpenWindows:
    """The windows of the query at ``checkpoint``."""

    def __init__(self, spark: SparkSession, checkpoint: str, config: WindowConfig):
        self.spark, self.checkpoint, self.config = spark, checkpoint.rstrip("/"), config
        self.location = f"{self.checkpoint}/windows"

    def _found(self, batch: int) -> tuple[Base | None, list[int]]:
        """The newest base of an earlier batch, and the batches since then, this one included."""
        names = [name.split("-") for name in children(self.spark, self.location)]
        base = max((Base(int(n[1]), int(n[2])) for n in names if n[0] == "base" and int(n[1]) < batch), default=None)
        first = base.batch + 1 if base else 0
        return base, sorted(int(n[1]) for n in names if n[0] == "delta" and first <= int(n[1]) <= batch)

    def _panes(self, base: Base | None, deltas: list[int], since: int | None = None) -> DataFrame:
        """Sums by pane of the base and the batches since then, several for a pane; ``since`` leaves out panes whose windows
        had all ended by this time in milliseconds."""
        def open_ones(rows: DataFrame) -> DataFrame:
            if since is None:
                return rows
            return rows.where(F.col("event_time") > F.timestamp_millis(F.lit(since - 1000 * (self.config.size + self.config.pane))))

        given = self.spark.read.schema(GIVEN).parquet(*[f"{self.location}/delta-{n}" for n in deltas])
        panes = pane_sums(open_ones(given), self.config.pane)
        if base is None:
            return panes
        held = self.spark.read.schema(_HELD).parquet(f"{self.location}/base-{base.batch}-{base.watermark}")
        return merge_partials(open_ones(held), "truck_id", F.window("event_time", seconds(self.config.pane))).unionByName(panes)

    def add(self, given: DataFrame, batch: int, emit: Callable[[DataFrame], None]) -> None:
        """Add what a batch is given, and hand the averages of the windows that it closes to ``emit``."""
        # The only action on these rows: a second one would run the duplicate filter's state again.
        given.write.mode("overwrite").parquet(f"{self.location}/delta-{batch}")
        watermark = watermark_of_batch(self.spark, self.checkpoint, batch)
        base, deltas = self._found(batch)
        pane = 1000 * self.config.pane
        if watermark // pane <= (base.watermark // pane if base else 0):
            return  # no window has ended since
        averages = averages_of_panes(self._panes(base, deltas), self.config)
        closed = averages.where(F.col("window_end") <= F.timestamp_millis(F.lit(watermark)))
        if base:
            closed = closed.where(F.col("window_end") > F.timestamp_millis(F.lit(base.watermark)))
        emit(closed)
        held = merge_partials(self._panes(base, deltas, watermark), "truck_id", "window")
        held.select(
            "truck_id", F.col("window.start").alias("event_time"), F.col("centi_sum").cast("decimal(38,0)").alias("centi_sum"),
            "reading_count",
        ).write.mode("overwrite").parquet(f"{self.location}/base-{batch}-{watermark}")
        if base:
            # Of no use to this batch, should it run again, nor to later ones.
            for name in children(self.spark, self.location):
                kind, number = name.split("-")[:2]
                if int(number) < base.batch or int(number) == base.batch and kind == "delta":
                    remove(self.spark, f"{self.location}/{name}")
