"""Removal of lines that many documents share, kept up to date as documents come and go.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z in lower case. Keys of at least ``MIN_CHARS``
code points that at least ``MIN_DOCS`` documents hold are *repeated*: all their lines go, but for those in the largest
id that holds the key. Other lines stay, joined by newlines.

State is two tables in a folder, both exact: ``postings`` (key, doc_id), each once, and ``counts`` (key, n_docs,
last_doc). In front of the counts stands a cuckoo filter for each shard of keys, which holds the repeated ones. Most
lines are told apart by the filters; only what they let through meets the counts. An insertion or deletion of
documents recounts the keys it touches and moves those that crossed ``MIN_DOCS`` into or out of the filters, so
that deleting what was inserted leads back to the same state.

Defined cases: a null or empty text is one empty line; rows without an id keep all their lines and count for no key;
rows that repeat an id count as one document and all get the same treatment; an empty table has an empty state.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.llm.common import batch_of, id_bytes, shared_folder, sql_type
from fleetgauge.llm.cuckoo import CuckooFilter, key_array

MIN_CHARS = 20
MIN_DOCS = 3
#: Repeated keys in a shard; its filter takes about 2.5 bytes for each.
SHARD_KEYS = 50_000
FILTER = "shard int, buckets binary, spare array<bigint>"


def line_keys(raw: bytes, min_chars: int = MIN_CHARS) -> list[bytes | None]:
    """A 128-bit hash of every line's key; None for lines that are too short to be repeated."""
    out = []
    for line in raw.split(b"\n"):
        line = line.strip().lower()  # of bytes: exactly the white space and the letters meant
        long = len(line) >= min_chars and len(line.decode()) >= min_chars
        out.append(xxhash.xxh3_128_digest(line) if long else None)
    return out


def postings_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_CHARS) -> DataFrame:
    """``key, doc_id`` for the keys of every document, each once."""
    rows = id_bytes(docs, id_col, text_col).filter("doc_id IS NOT NULL")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, keys = [], []
            for i, raw in enumerate(batch.column(1)):
                own = {k for k in line_keys(raw.as_py(), min_chars) if k}
                at += [i] * len(own)
                keys += own
            yield batch_of({"key": pa.binary()}, batch.column(0).take(pa.array(at, type=pa.int32())), [keys])

    return rows.mapInArrow(work, f"doc_id {sql_type(rows, 'doc_id')}, key binary").distinct()


def counts_of(postings: DataFrame) -> DataFrame:
    return postings.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc"))


def shard_of(n_shards: int):
    return F.pmod(F.xxhash64("key"), F.lit(n_shards)).cast("int").alias("shard")


def build_filters(counts: DataFrame, n_shards: int, min_docs: int = MIN_DOCS) -> DataFrame:
    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        made = CuckooFilter.empty(len(rows))
        made.insert(key_array(rows["key"].tolist()))
        buckets, spare = made.dump()
        return pd.DataFrame({"shard": [key[0]], "buckets": [buckets], "spare": [spare]})

    return (counts.filter(F.col("n_docs") >= min_docs).select("key", shard_of(n_shards))
            .groupBy("shard").applyInPandas(build, FILTER))


class LineIndex:
    """The state in ``folder``. Every change writes a new version beside the old ones; ``undo`` goes back one."""

    def __init__(self, spark: SparkSession, folder: str, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS):
        self.spark, self.folder, self.min_chars, self.min_docs = spark, folder, min_chars, min_docs
        self.version, self.n_shards = -1, 1

    def table(self, name: str, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}-{self.version if version is None else version}")


    @classmethod
    def build(cls, docs: DataFrame, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text",
              min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, shard_keys: int = SHARD_KEYS) -> LineIndex:
        """State of all ``docs`` at once; the number of shards follows the number of repeated keys."""
        spark = docs.sparkSession
        self = cls(spark, folder or shared_folder(spark, "lines"), min_chars, min_docs)
        postings = postings_of(docs, id_col, text_col, min_chars)
        postings.write.parquet(f"{self.folder}/postings-0")
        counts_of(self.table("postings", 0)).write.parquet(f"{self.folder}/counts-0")
        counts = self.table("counts", 0)
        self.n_shards = counts.filter(F.col("n_docs") >= min_docs).count() // shard_keys + 1
        build_filters(counts, self.n_shards, min_docs).write.parquet(f"{self.folder}/filters-0")
        self.version = 0
        return self

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Take in documents whose ids the state doesn't hold yet."""
        new = postings_of(docs, id_col, text_col, self.min_chars)
        self._change(self.table("postings").unionByName(new), new.select("key").distinct())

    def delete(self, ids: DataFrame) -> None:
        """Take out the documents whose ids are in the column ``doc_id`` of ``ids``."""
        old, gone = self.table("postings"), ids.select("doc_id").distinct()
        self._change(old.join(gone, "doc_id", "left_anti"),
                     old.join(gone, "doc_id", "left_semi").select("key").distinct())

    def _change(self, postings: DataFrame, touched: DataFrame) -> None:
        before, least, kept = self.table("counts"), self.min_docs, self.version
        postings.write.parquet(f"{self.folder}/postings-{kept + 1}")
        touched.write.parquet(f"{self.folder}/touched-{kept + 1}")
        touched = self.table("touched", kept + 1)
        recounted = counts_of(self.table("postings", kept + 1).join(touched, "key", "left_semi"))
        before.join(touched, "key", "left_anti").unionByName(recounted).write.parquet(f"{self.folder}/counts-{kept + 1}")
        was = before.join(touched, "key", "left_semi").select("key", F.col("n_docs").alias("was"))
        now = recounted.select("key", F.col("n_docs").alias("now"))
        crossed = (touched.join(was, "key", "left").join(now, "key", "left")
                   .select("key", shard_of(self.n_shards), (F.coalesce("was", F.lit(0)) >= least).alias("was"),
                           (F.coalesce("now", F.lit(0)) >= least).alias("now")).filter("was != now"))

        def move(key: tuple, old: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            own = (CuckooFilter.load(old["buckets"][0], list(old["spare"][0])) if len(old)
                   else CuckooFilter.empty(len(rows)))
            for joins, change in ((False, own.delete), (True, own.insert)):
                keys = rows.loc[rows["now"] == joins, "key"].tolist()
                if keys:
                    change(key_array(keys))
            buckets, spare = own.dump()
            return pd.DataFrame({"shard": [key[0]], "buckets": [buckets], "spare": [spare]})

        (self.table("filters").groupBy("shard").cogroup(crossed.groupBy("shard")).applyInPandas(move, FILTER)
         .write.parquet(f"{self.folder}/filters-{kept + 1}"))
        self.version += 1

    def undo(self) -> None:
        self.version -= 1

    def passed(self, postings: DataFrame) -> DataFrame:
        """The postings whose keys the filters hold: a few too many, none too few.

        A shard's filter goes to as many cells as make the cells a few for each partition, and a shard's postings
        are dealt to them by the document; a key in a third of all documents is thus in many tasks. A task reads
        a cell's filter first, then its postings in batches.
        """
        partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        salts = -(-4 * partitions // self.n_shards)
        kind = sql_type(postings, "doc_id")
        own = postings.select(shard_of(self.n_shards), F.pmod(F.xxhash64("doc_id", "key"), F.lit(salts)).cast("int")
                              .alias("salt"), F.lit(1).alias("part"), "doc_id", "key",
                              F.lit(None).cast("binary").alias("buckets"),
                              F.lit(None).cast("array<bigint>").alias("spare"))
        filters = self.table("filters").select(
            "shard", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("part"),
            F.lit(None).cast(kind).alias("doc_id"), F.lit(None).cast("binary").alias("key"), "buckets", "spare")
        cells = (filters.unionByName(own).repartition(partitions, "shard", "salt")
                 .sortWithinPartitions("shard", "salt", "part"))

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cell, known = None, None
            for batch in batches:
                shards, salts_, parts = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
                keep = np.zeros(len(parts), dtype=bool)
                edges = np.flatnonzero((np.diff(shards) != 0) | (np.diff(salts_) != 0) | (np.diff(parts) != 0)) + 1
                for begin, end in zip([0, *edges], [*edges, len(parts)], strict=True):
                    if begin == end:
                        continue
                    if parts[begin] == 0:
                        cell = shards[begin], salts_[begin]
                        known = CuckooFilter.load(batch.column(5)[begin].as_py(), batch.column(6)[begin].as_py())
                    elif cell == (shards[begin], salts_[begin]):
                        keep[begin:end] = known.holds(key_array(batch.column(4).slice(begin, end - begin).to_pylist()))
                yield batch.select(["doc_id", "key"]).filter(pa.array(keep))

        return cells.mapInArrow(probe, f"doc_id {kind}, key binary")

    def drops(self) -> DataFrame:
        """``doc_id, keys``: the keys that each document of the state loses."""
        counts = self.table("counts").filter(F.col("n_docs") >= self.min_docs).select("key", "last_doc")
        lost = self.passed(self.table("postings")).join(counts, "key").filter("doc_id < last_doc")
        return lost.groupBy("doc_id").agg(F.collect_list("key").alias("keys"))

    def clean(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``doc_id, text, n_lines, n_dropped, kept_sha256`` of documents that the state holds; ``text`` is what is
        left."""
        rows, least = id_bytes(docs, id_col, text_col).join(self.drops(), "doc_id", "left"), self.min_chars
        out = {"text": pa.string(), "n_lines": pa.int64(), "n_dropped": pa.int64(), "kept_sha256": pa.string()}

        def one(raw: bytes, keys: list[bytes] | None) -> tuple:
            lines, drop = raw.split(b"\n"), set(keys or ())
            kept = [x for x, k in zip(lines, line_keys(raw, least), strict=True) if k not in drop] if drop else lines
            text = b"\n".join(kept)
            return text.decode(), len(lines), len(lines) - len(kept), sha256(text).hexdigest()

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [one(raw.as_py(), keys.as_py()) for raw, keys in zip(*batch.columns[1:], strict=True)]
                yield batch_of(out, batch.column(0), list(zip(*found, strict=True)) or [[]] * len(out))

        return rows.select("doc_id", "text", "keys").mapInArrow(
            work, f"doc_id {sql_type(rows, 'doc_id')}, text string, n_lines bigint, n_dropped bigint, kept_sha256 string")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``LineIndex.clean`` over a state made of the same documents."""
    return LineIndex.build(docs, id_col=id_col, text_col=text_col).clean(docs, id_col, text_col)
