"""Time travel: snapshots of the state beside its log, and the part of the log behind one of them.

    LOCATION/state/at=N/        the live entries after the log's batches up to N
    LOCATION/positions/at=N/    the last offset of each partition in that snapshot

A snapshot is made of the one before and what the log got since, and counts once its positions are there.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.operators.state import compact_changelog, materialize_changelog
from fleetgauge.session import move
from fleetgauge.sources.changelog import decode_changelog
from fleetgauge.sources.segments import Positions, SegmentLog

_POSITION = "at bigint, partition int, offset bigint"


class Snapshot(NamedTuple):
    at: int
    positions: Positions


class StateHistory:
    """Snapshots below ``location`` of the state whose changes are in ``log``."""

    def __init__(self, log: SegmentLog, location: str):
        self.log, self.location, self.spark = log, location.rstrip("/"), log.spark

    def snapshots(self) -> list[Snapshot]:
        """All snapshots, oldest first: one row per snapshot and partition."""
        try:
            rows = self.spark.read.schema(_POSITION).parquet(f"{self.location}/positions").collect()
        except AnalysisException:
            return []
        found: dict[int, Positions] = {}
        for r in rows:
            found.setdefault(r.at, {})[r.partition] = r.offset
        return [Snapshot(at, found[at]) for at in sorted(found)]

    def _entries(self, snapshot: Snapshot | None, until: Positions) -> DataFrame:
        """The entries of a snapshot and, behind it, of the log up to ``until``."""
        tail = decode_changelog(self.log.read(after=snapshot.positions if snapshot else None, until=until))
        tail = tail.select("key", "value", "seq")
        if snapshot is None:
            return tail
        held = self.spark.read.schema(tail.schema).parquet(f"{self.location}/state/at={snapshot.at}")
        return held.unionByName(tail)

    def take(self) -> Snapshot | None:
        """A snapshot of all that the log has committed; None if there is nothing new."""
        ends, known = self.log.ends(), self.snapshots()
        last = known[-1] if known else None
        if not ends or (last and last.positions == ends):
            return None
        at = last.at + 1 if last else 0
        live = compact_changelog(self._entries(last, ends)).where(F.col("value").isNotNull())
        live.write.mode("overwrite").parquet(f"{self.location}/state/at={at}")
        hidden = f"{self.location}/positions/_{uuid.uuid4().hex}"
        rows = [(p, o) for p, o in ends.items()]
        self.spark.createDataFrame(rows, "partition int, offset bigint").coalesce(1).write.parquet(hidden)
        if not move(self.spark, hidden, f"{self.location}/positions/at={at}"):
            raise RuntimeError(f"snapshot {at} of {self.location} is there already")
        return Snapshot(at, ends)

    def nearest(self, offsets: Positions) -> Snapshot | None:
        """The newest snapshot that is ahead of ``offsets`` in no partition."""
        fitting = [s for s in self.snapshots() if all(o <= offsets.get(p, -1) for p, o in s.positions.items())]
        return fitting[-1] if fitting else None

    def state_at(self, offsets: Positions) -> DataFrame:
        """Live state after the entry at the given offset of each partition; of a partition that is not named nothing
        has been read. Reads the nearest snapshot and the files of the log behind it."""
        return materialize_changelog(self._entries(self.nearest(offsets), offsets))
