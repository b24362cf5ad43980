"""The state of a changelog kept up to date by small merges instead of full replays.

    LOCATION/data/<generation>/bucket=B/    entries of keys that hash into bucket B
    LOCATION/versions/version=V/            which generations make up each bucket, as of version V

Changes come in as delta generations. A merge takes the buckets with enough deltas, joins them with their base into a
new base and leaves all other buckets as they are. Deletions stay in deltas, where they hide older entries, and go when
a bucket is merged, as nothing older is left then. Whatever is done ends with a new version, a folder that
appears in one step, so that readers see the state before or after and nothing between. There are at most
``buckets`` times (deltas + 1) rows in a version.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.operators.state import compact_changelog, materialize_changelog
from fleetgauge.session import move

BUCKETS = 64
BASE, DELTA = "base", "delta"
MANIFEST = "bucket int, generation string, kind string, number bigint, applied bigint"
ENTRY = "key string, value struct<sum: double, count: bigint>, seq bigint, bucket int"


class Conflict(RuntimeError):
    """Another writer has made the version first."""


class StateTable:
    def __init__(self, spark: SparkSession, location: str, buckets: int = BUCKETS):
        self.spark, self.location, self.buckets = spark, location.rstrip("/"), buckets

    def version(self) -> int:
        """The newest version; -1 before the first."""
        try:
            found = self.spark.read.schema(f"{MANIFEST}, version bigint").parquet(f"{self.location}/versions")
        except AnalysisException:
            return -1
        newest = found.agg(F.max("version")).first()[0]
        return -1 if newest is None else newest

    def manifest(self, version: int | None = None) -> list:
        """The rows of a version, by default the newest, without the row that only says what has been applied."""
        return [r for r in self._rows(self.version() if version is None else version) if r.generation]

    def _rows(self, version: int) -> list:
        if version < 0:
            return []
        return self.spark.read.schema(MANIFEST).parquet(f"{self.location}/versions/version={version}").collect()

    def _publish(self, version: int, rows: list[tuple], applied: int) -> int:
        hidden = f"{self.location}/versions/_{uuid.uuid4().hex}"
        rows = [(*r, applied) for r in rows] + [(None, None, None, None, applied)]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(hidden)
        if not move(self.spark, hidden, f"{self.location}/versions/version={version}"):
            raise Conflict(f"version {version} of {self.location} is there already")
        return version

    def _write(self, entries: DataFrame) -> tuple[str, list[int]]:
        """Entries as a new generation, a folder that nothing refers to yet, and the buckets that have some."""
        generation = uuid.uuid4().hex
        path = f"{self.location}/data/{generation}"
        entries.repartition(F.col("bucket")).write.partitionBy("bucket").parquet(path)
        buckets = self.spark.read.schema(ENTRY).parquet(path).select("bucket").distinct().collect()
        return generation, sorted(r.bucket for r in buckets)

    def _entries(self, rows: list) -> DataFrame:
        if not rows:
            return self.spark.createDataFrame([], ENTRY)
        paths = [f"{self.location}/data/{r.generation}/bucket={r.bucket}" for r in rows]
        return self.spark.read.schema(ENTRY.rsplit(", ", 1)[0]).parquet(*paths)

    def _placed(self, changelog: DataFrame, order: str) -> DataFrame:
        last = compact_changelog(changelog, order).withColumnRenamed(order, "seq")
        return last.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int"))

    def applied(self) -> int:
        """The last batch that has been applied; -1 before the first."""
        rows = self._rows(self.version())
        return rows[0].applied if rows else -1

    def apply(self, changelog: DataFrame, batch: int | None = None, order: str = "seq") -> int:
        """Add changes ``(key, value, seq)`` as a delta. A batch that was applied already changes nothing, so that
        ``foreachBatch`` may call this again after a failure. The version in which the changes are."""
        version = self.version()
        rows = self._rows(version)
        done = rows[0].applied if rows else -1
        if batch is None:
            batch = done + 1
        if batch <= done:
            return version
        generation, buckets = self._write(self._placed(changelog, order))
        held = [tuple(r)[:4] for r in rows if r.generation]
        return self._publish(version + 1, held + [(b, generation, DELTA, batch) for b in buckets], batch)

    def merge(self, least: int = 4) -> list[int]:
        """Merge the buckets that have at least ``least`` deltas, and return them."""
        version = self.version()
        rows = self._rows(version)
        deltas: dict[int, int] = {}
        for r in rows:
            if r.kind == DELTA:
                deltas[r.bucket] = deltas.get(r.bucket, 0) + 1
        touched = sorted(b for b, n in deltas.items() if n >= least)
        if not touched:
            return []
        merged = self._placed(self._entries([r for r in rows if r.bucket in touched]), "seq")
        generation, filled = self._write(merged.where(F.col("value").isNotNull()))
        kept = [tuple(r)[:4] for r in rows if r.generation and r.bucket not in touched]
        self._publish(version + 1, kept + [(b, generation, BASE, version + 1) for b in filled], rows[0].applied)
        return touched

    def entries(self, version: int | None = None) -> DataFrame:
        """All entries of a version, several of a key where deltas have not been merged."""
        return self._entries(self.manifest(version))

    def live(self, version: int | None = None) -> DataFrame:
        """Live state ``(truck_id, sum, count, average)`` of a version, by default the newest."""
        return materialize_changelog(self.entries(version))
