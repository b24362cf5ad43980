"""A keyed log in files, committed in batches, with an index of what each file holds.

    LOCATION/segments/batch=N/     the rows of a batch, visible all at once
    LOCATION/index/commit=N/       one row per file and partition: offsets, times, number of rows, a digest

A batch is written to a hidden folder, moved to its place in one step and then indexed. Without an index it isn't
committed: readers pass it over, and whoever writes that number again indexes what is there, or replaces what was
left half written in the hidden folder. A committed batch is never written again, so that a stream's batch that
runs twice leaves one copy.

The index says which files a read between two positions needs; the others aren't opened. It has a row per file and
partition, and what the driver gets of it are file names, as with any folder that Spark reads. Moving a folder is one
step in HDFS and local file systems; in an object store it is a copy.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge.functions.times import instant
from fleetgauge.session import move

INDEX = (
    "batch bigint, file string, partition int, first_offset bigint, last_offset bigint, "
    "first_time timestamp, last_time timestamp, records bigint, digest decimal(38,0)"
)
_INDEX_COLUMNS = [column.split()[0] for column in INDEX.split(", ")]
Positions = dict[int, int]


def _digest(columns: Iterable[str]) -> Column:
    """A number that changes when a row of a file is changed, lost or doubled."""
    return F.sum(F.xxhash64(*sorted(columns)).cast("decimal(38,0)")).alias("digest")


def _at(positions: Positions) -> Column:
    """The position of a row's partition; null for a partition that isn't named."""
    pairs = [F.lit(x) for p, o in positions.items() for x in (int(p), int(o))]
    return F.element_at(F.create_map(*pairs), F.col("partition")) if pairs else F.lit(None).cast("bigint")


class SegmentLog:
    """The log at ``location``, whose rows have the columns of ``schema``, ``partition`` and ``offset`` among them."""

    def __init__(self, spark: SparkSession, location: str, schema: T.StructType):
        self.spark, self.location, self.schema = spark, location.rstrip("/"), schema

    def index(self) -> DataFrame:
        """The index of all committed batches: a row per file and partition."""
        return self._commits().where(F.col("file").isNotNull())

    def _commits(self) -> DataFrame:
        """The index with a row more for each batch, which an empty one has alone."""
        try:
            return self.spark.read.schema(INDEX).parquet(f"{self.location}/index").select(*_INDEX_COLUMNS)
        except AnalysisException:  # nothing has been committed yet
            return self.spark.createDataFrame([], INDEX)

    def batches(self) -> set[int]:
        return {r.batch for r in self._commits().select("batch").distinct().collect()}

    def _segment(self, batch: int) -> str:
        return f"{self.location}/segments/batch={batch}"

    def _file_rows(self, path: str) -> DataFrame:
        rows = self.spark.read.schema(self.schema).parquet(path)
        return rows.withColumn("file", F.col("_metadata.file_name"))

    def _described(self, batch: int) -> DataFrame:
        """The index of the files that a batch's folder holds now."""
        rows = self._file_rows(self._segment(batch))
        time = F.col("timestamp") if "timestamp" in self.schema.names else F.lit(None).cast("timestamp")
        found = rows.groupBy("file", "partition").agg(
            F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
            F.min(time).alias("first_time"), F.max(time).alias("last_time"),
            F.count("*").alias("records"), _digest(self.schema.names))
        return found.withColumn("batch", F.lit(batch).cast("bigint"))

    def write_segment(self, rows: DataFrame, batch: int) -> None:
        """Put the rows of a batch in their place without committing them. A batch that is in its place stays."""
        hidden = f"{self.location}/segments/_batch={batch}"
        picked = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        picked.sortWithinPartitions("partition", "offset").write.mode("overwrite").parquet(hidden)
        move(self.spark, hidden, self._segment(batch))

    def commit(self, batch: int) -> None:
        """Index a batch that is in its place."""
        hidden = f"{self.location}/index/_commit={batch}"
        itself = self.spark.createDataFrame([(batch, *[None] * (len(_INDEX_COLUMNS) - 1))], INDEX)
        self._described(batch).select(*_INDEX_COLUMNS).union(itself).coalesce(1).write.mode("overwrite").parquet(hidden)
        move(self.spark, hidden, f"{self.location}/index/commit={batch}")

    def append(self, rows: DataFrame, batch: int | None = None) -> int:
        """Write and commit a batch, by default the next one; one that is committed is left as it is. Its number."""
        known = self.batches()
        if batch is None:
            batch = max(known, default=-1) + 1
        if batch not in known:
            self.write_segment(rows, batch)
            self.commit(batch)
        return batch

    def append_bounded(
        self, rows: DataFrame, most: int, order: str = "offset", after: Callable[[int], None] | None = None
    ) -> list[int]:
        """Write and commit ``rows`` in batches of at most ``most`` rows, cut by ``order``, in which rows must differ.

        The cuts come from a summary of ``order`` that is exact to a tenth of a batch, so that batches are made a little
        smaller than ``most``. ``rows`` is read once per batch, and should be a table. ``after`` is called with each batch's
        number once it is committed.
        """
        total = rows.count()
        parts = -(-total * 5 // (most * 4)) if total else 0
        if parts > 1:
            shares = [k / parts for k in range(1, parts)]
            cuts = rows.agg(F.percentile_approx(order, shares, 20 * parts)).first()[0]
        else:
            cuts = []
        done = []
        for k in range(parts):
            part = rows
            if k:
                part = part.where(F.col(order) > cuts[k - 1])
            if k < len(cuts):
                part = part.where(F.col(order) <= cuts[k])
            done.append(self.append(part))
            if after:
                after(done[-1])
        return done

    def ends(self) -> Positions:
        """The last committed offset of each partition: one row per partition."""
        last = self.index().groupBy("partition").agg(F.max("last_offset").alias("at")).collect()
        return {r.partition: r.at for r in last}

    def files(self, after: Positions | None = None, until: Positions | None = None, since: datetime | None = None,
              before: datetime | None = None) -> list[str]:
        """The files that hold rows behind ``after`` and not behind ``until``, and that arrived from ``since`` on and before
        ``before``. Partitions that ``after`` doesn't name are read from their start, those that ``until``
        doesn't name not at all."""
        found = self.index()
        if after is not None:
            found = found.where(F.col("last_offset") > F.coalesce(_at(after), F.lit(-1)))
        if until is not None:
            found = found.where(F.col("first_offset") <= _at(until))
        if since is not None:
            found = found.where(F.col("last_time") >= instant(since))
        if before is not None:
            found = found.where(F.col("first_time") < instant(before))
        names = found.select("batch", "file").distinct().collect()
        return sorted(f"{self._segment(r.batch)}/{r.file}" for r in names)

    def read(self, after: Positions | None = None, until: Positions | None = None, since: datetime | None = None,
             before: datetime | None = None) -> DataFrame:
        """The committed rows behind ``after`` and not behind ``until``, from ``since`` on and before ``before``."""
        paths = self.files(after, until, since, before)
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(*paths)
        if after is not None:
            rows = rows.where(F.col("offset") > F.coalesce(_at(after), F.lit(-1)))
        if until is not None:
            rows = rows.where(F.col("offset") <= _at(until))
        if since is not None:
            rows = rows.where(F.col("timestamp") >= instant(since))
        if before is not None:
            rows = rows.where(F.col("timestamp") < instant(before))
        return rows

    def read_batch(self, batch: int) -> DataFrame:
        """The rows of one committed batch."""
        if batch not in self.batches():
            raise KeyError(f"batch {batch} of {self.location} is not committed")
        return self.spark.read.schema(self.schema).parquet(self._segment(batch))

    def position_of_time(self, moment: datetime) -> Positions:
        """The last offset of each partition that arrived before ``moment``, to read on behind it."""
        rows = self.read(before=moment)
        return {r[0]: r[1] for r in rows.groupBy("partition").agg(F.max("offset")).collect()}

    def stream(self, after: Positions | None = None, **options: str) -> DataFrame:
        """The log as a stream, new batches as they come, behind ``after``. Only batches in their place are seen."""
        rows = self.spark.readStream.schema(self.schema).options(**options).parquet(f"{self.location}/segments/batch=*")
        return rows if after is None else rows.where(F.col("offset") > F.coalesce(_at(after), F.lit(-1)))

    def damaged(self) -> DataFrame:
        """``batch, file`` of committed files whose rows are no longer those that were committed, missing ones included."""
        paths = self.files()
        if not paths:
            return self.index().select("batch", "file")
        rows = self.spark.read.option("ignoreMissingFiles", "true").schema(self.schema).parquet(f"{self.location}/segments")
        rows = rows.withColumn("file", F.col("_metadata.file_name"))
        now = rows.groupBy("file", "partition").agg(F.count("*").alias("_records"), _digest(self.schema.names))
        was = self.index()
        both = was.join(now.withColumnRenamed("digest", "_digest"), ["file", "partition"], "left")
        same = F.col("records").eqNullSafe(F.col("_records")) & F.col("digest").eqNullSafe(F.col("_digest"))
        return both.where(~same).select("batch", "file").distinct()


EARLIEST, LATEST = "earliest", "latest"


def start_positions(log: SegmentLog, start: str, keep: str | None = None) -> Positions | None:
    """The positions behind which a read begins; None for the whole log.

    ``start`` is ``earliest``, ``latest``, an ISO time from which on rows have arrived, or offsets as JSON,
    ``{"0": 17}``, the first to be read of each partition. What it means is found out once where ``keep`` names a folder
    for it: a stream that starts again from its checkpoint must not look for the latest offset anew.
    """
    spark, schema = log.spark, "partition int, offset bigint"
    if keep:
        try:
            rows = spark.read.schema(schema).parquet(keep).collect()
            return {r.partition: r.offset for r in rows if r.partition is not None} or None
        except AnalysisException:
            pass
    if start == EARLIEST:
        found = None
    elif start == LATEST:
        found = log.ends()
    elif start.lstrip().startswith("{"):
        found = {int(p): int(o) - 1 for p, o in json.loads(start).items()}
    else:
        moment = datetime.fromisoformat(start)
        found = log.position_of_time(moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc))
    if keep:
        rows = list((found or {}).items()) + [(None, None)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(keep)
    return found
